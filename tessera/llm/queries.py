"""Registry of the training-data queries: ``QUERIES[name] = fn(spark, sf_dir)``, ``ORACLES[name]``
= DuckDB SQL where SQL can express the operator on whole tables."""

from __future__ import annotations

from . import collocations, topk
from .bpe import op2_bpe_codec
from .decontaminate import op10_decontaminate
from .jaccard_join import op9_jaccard_join
from .language import op7_language_id
from .manifest import op11_manifest
from .packing import op12_packing
from .sharding import op1_sharding
from .suffix_array import op4_suffix_array
from .suffix_tree import op8_suffix_tree
from .token_counts import op6_token_counts
from .toxicity import op3_toxicity

QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_bpe_codec": op2_bpe_codec,
    "op3_toxicity": op3_toxicity,
    "op4_suffix_array": op4_suffix_array,
    "op5_topk": topk.op5_topk,
    "op6_token_counts": op6_token_counts,
    "op7_language_id": op7_language_id,
    "op8_suffix_tree": op8_suffix_tree,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_decontaminate": op10_decontaminate,
    "op11_manifest": op11_manifest,
    "op12_packing": op12_packing,
    "op13_collocations": collocations.op13_collocations,
}
ORACLES: dict[str, str] = {"op5_topk": topk.ORACLE, "op13_collocations": collocations.ORACLE}

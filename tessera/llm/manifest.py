"""Merkle manifest of a dataset, with leaf places by bitmap ranks.

**Leaves.**  A row's leaf is the SHA-256 of its fields, each ``-`` if null, else its UTF-8 length,
``:`` and the value.  Rows of one group (language) stand in the order of their ids.

**Places.**  Each group has a compressed bitmap of its ids: 64-bit words, kept only where they
are not empty, merged by ``bit_or`` while they are shuffled, next to a directory of counts:
the rows before each word, summed level by level over ``FAN`` words, so that no level of
a group is summed in one task.  A row's place is the count before its word plus the popcount of
the lower bits; rows are not sorted.  Only words that hold an id more than once take a second
look: their rows are placed by the counts of the smaller ids and, among equal ids, by leaf
(equal leaves in any order, which changes nothing in the result); this order is summed over
ranges, so an id that a third of all rows share is no task's load.

**Levels.**  A node goes to the slot array of its block (``BLOCK`` consecutive nodes of a group);
a block is reduced ``LEVELS`` levels at once, and the blocks' tops are the next nodes: every
round leaves a 64th.  On the way back each block learns the siblings above it, so a row has
its whole proof after as many joins.  Group roots form one more tree of the same kind.

A null id stands where the least long would, so null ids come first in their group; null groups come first; repeated rows are leaves of
their own; empty and null texts differ (``0:`` and ``-``); an empty table gives no rows; extra
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.prefix import running_totals
from ..session import ship_package, stage_table
from .bitmap import LEAST_ID

ARITY = 8
LEVELS = 2  # levels that one round reduces
BLOCK = ARITY ** LEVELS
FAN_BITS = 10
FAN = 1 << FAN_BITS
TOP = 4 * FAN  # at most so many counts of a group are summed in one window
CHUNK = 256  # blocks that are plain lists at a time

PROOF = "array<struct<left:string,right:string>>"


def digest(*fields: Column) -> Column:
    """SHA-256 (hex) of the fields: ``-`` if null, else UTF-8 length, ``:`` and the value."""
    text = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]).cast("binary"), 256)


def depth(n: Column) -> Column:
    """Levels above n leaves."""
    out = F.lit(21)
    for d in range(20, -1, -1):
        out = F.when(n <= ARITY ** d, d).otherwise(out)
    return out


def directory(rows: DataFrame) -> DataFrame:
    """(grp, word, bits, n, before, total): bitmap words of the ids of each group, the rows in
    the word, in the group before it, and in the whole group."""
    words = stage_table(rows.groupBy("grp", F.shiftright("id", 6).alias("word"))
                        .agg(F.expr("bit_or(shiftleft(1L, cast(id & 63 as int)))").alias("bits"), F.count(F.lit(1)).alias("n")))
    levels = [words.select("grp", F.col("word").alias("node"), "n")]
    while levels[-1].groupBy("grp").count().agg(F.max("count")).first()[0] > TOP:
        levels.append(stage_table(levels[-1].groupBy("grp", F.shiftright("node", FAN_BITS).alias("node")).agg(F.sum("n").alias("n"))))
    whole = Window.partitionBy("grp")  # at most TOP rows
    upto = whole.orderBy("node").rowsBetween(Window.unboundedPreceding, 0)
    known = levels.pop().withColumns({"before": F.sum("n").over(upto) - F.col("n"), "total": F.sum("n").over(whole)})
    while levels:
        inside = Window.partitionBy("grp", "parent").orderBy("node").rowsBetween(Window.unboundedPreceding, 0)  # at most FAN rows
        part = levels.pop().withColumn("parent", F.shiftright("node", FAN_BITS)).withColumn("inner", F.sum("n").over(inside) - F.col("n"))
        above = known.select("grp", F.col("node").alias("parent"), "before", "total")
        known = part.join(above, ["grp", "parent"]).select("grp", "node", "n", (F.col("before") + F.col("inner")).alias("before"), "total")
    return words.join(known.select("grp", F.col("node").alias("word"), "before", "total"), ["grp", "word"])


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` (grp, id, leaf, uid, ...) with ``place`` (from 0 in its group) and ``total``."""
    words = stage_table(directory(rows))
    found = rows.withColumn("word", F.shiftright("id", 6)).join(words, ["grp", "word"])
    lower = F.expr("cast(bit_count(bits & ~shiftleft(-1L, cast(id & 63 as int))) as long)")
    keep = [*rows.columns, "total"]
    repeats = F.col("n") > F.expr("bit_count(bits)")
    single = found.filter(~repeats).select(*keep, (F.col("before") + lower).alias("place"))
    crowded = words.filter(repeats)
    if crowded.isEmpty():
        return single
    several = stage_table(found.filter(repeats))
    ids = several.groupBy("grp", "word", "id").agg(F.count(F.lit(1)).alias("m"))
    smaller = Window.partitionBy("grp", "word").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)  # at most 64 ids
    ids = stage_table(ids.withColumn("lower", F.sum("m").over(smaller) - F.col("m")))
    starts = running_totals(ids.select("grp", "id", "m", "lower"), ["grp", "id"], ["m"]).select("grp", "id", "lower", (F.col("cum_m") - F.col("m")).alias("start"))
    order = running_totals(several, ["grp", "id", "leaf", "uid"], [])
    tied = order.join(starts, ["grp", "id"]).select(*keep, (F.col("before") + F.col("lower") + F.col("__rank") - 1 - F.col("start")).alias("place"))
    return single.unionByName(tied)


def _hash(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _slots(nodes: list[dict]) -> list[dict]:
    """Slot array of a block: each node at its slot."""
    out: list = [None] * len(nodes)
    for x in nodes:
        out[x["slot"]] = x
    return out


def _levels(hashes: list[str], many: int) -> list[list[str]]:
    out = [hashes]
    for _ in range(many):
        out.append([_hash(out[-1][i:i + ARITY]) for i in range(0, len(out[-1]), ARITY)])
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    for batch in batches:
        for lo in range(0, batch.num_rows, CHUNK):
            yield batch.slice(lo, CHUNK).to_pylist()


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tops of the blocks."""
    schema = pa.schema([("grp", pa.string()), ("total", pa.int64()), ("place", pa.int64()), ("hash", pa.string())])
    for rows in _blocks(batches):
        yield pa.RecordBatch.from_pylist([
            {"grp": r["grp"], "total": r["total"], "place": r["block"], "hash": _levels([x["hash"] for x in _slots(r["nodes"])], r["levels"])[-1][0]} for r in rows], schema)


def _proved(names: list[str]):
    """The nodes of each block with the siblings up to the root."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.schema.field("nodes").type.value_type
            typed = [pa.field(n, pa.int64() if n == "place" else batch.schema.field("root").type if n in ("root", "subroot", "grp")
                              else batch.schema.field("proof").type if n == "proof" else node.field(node.get_field_index(n)).type) for n in names]
            for rows in _blocks([batch]):
                out: dict = {n: [] for n in names}
                for r in rows:
                    nodes = _slots(r["nodes"])
                    level = _levels([x["hash"] for x in nodes], r["levels"])
                    # siblings of every node of each level below the block's top
                    side = [[{"left": "".join(a[j - j % ARITY:j]), "right": "".join(a[j + 1:j - j % ARITY + ARITY])} for j in range(len(a))] for a in level[:-1]]
                    for slot, x in enumerate(nodes):
                        own = {"place": r["block"] * BLOCK + slot, "proof": [s[slot // ARITY ** d] for d, s in enumerate(side)] + r["proof"]}
                        for n in names:
                            out[n].append(own[n] if n in own else r[n] if n in ("root", "subroot", "grp") else x[n])
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in typed], [f.name for f in typed])
    return run


def reduce_levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(slot arrays of each round, roots (grp, total, place = 0, hash)) of the trees over the
    nodes (grp, total, place, hash, ...) of each group."""
    most = nodes.agg(F.max("total")).first()[0] or 0
    rounds, done = [], 0
    while not rounds or ARITY ** done < most:
        extra = [c for c in nodes.columns if c not in ("grp", "total", "place")]
        slot = F.struct((F.col("place") % BLOCK).cast("int").alias("slot"), *extra)
        block = nodes.groupBy("grp", "total", F.expr(f"place div {BLOCK}").alias("block")).agg(F.collect_list(slot).alias("nodes"))
        levels = F.greatest(F.lit(0), F.least(F.lit(LEVELS), depth(F.col("total")) - done)).cast("int")
        rounds.append(stage_table(block.withColumn("levels", levels)))
        nodes = stage_table(rounds[-1].mapInArrow(_reduced, "grp string, total long, place long, hash string"))
        done += LEVELS
    return rounds, nodes


def prove(rounds: list[DataFrame], roots: DataFrame, carry: str) -> DataFrame:
    """The nodes of the first round, the columns ``carry`` of them ("name type, ..."), with grp,
    root, subroot and proof; ``roots``: (grp, root, subroot, proof above the group's root)."""
    known = roots.withColumn("block", F.lit(0).cast("long"))
    for i, blocks in enumerate(reversed(rounds)):
        last = i == len(rounds) - 1
        out = "grp string, place long, root string, subroot string, proof " + PROOF + (", " + carry if last else "")
        names = ["grp", "place", "root", "subroot", "proof"] + ([c.split()[0] for c in carry.split(", ")] if last else [])
        known = blocks.join(known, ["grp", "block"]).mapInArrow(_proved(names), out)
        if not last:
            known = stage_table(known.withColumnRenamed("place", "block"))
    return known


def manifest(documents: DataFrame, leaf: Column, *, group: Column, id_: Column, other: Column | None = None) -> DataFrame:
    """id, leaf, other, place, proof, subroot, root of every row.  ``leaf``: its digest; ``other``:
    any text to carry along; ``proof``: for each level the siblings to the left and right."""
    spark = documents.sparkSession
    ship_package(spark)
    name = group.cast("string")
    rows = stage_table(documents.select(
        F.coalesce(F.concat(F.lit("="), name), F.lit("")).alias("grp"), F.coalesce(id_.cast("long"), F.lit(LEAST_ID)).alias("id"), id_.cast("long").alias("doc"),
        leaf.alias("leaf"), (F.lit(None).cast("string") if other is None else other).alias("other"), F.monotonically_increasing_id().alias("uid")))
    if rows.isEmpty():
        return spark.createDataFrame([], f"id long, leaf string, other string, place long, proof {PROOF}, subroot string, root string")
    nodes = placed(rows).select("grp", "total", "place", F.col("leaf").alias("hash"), "doc", "other")
    rounds, tops = reduce_levels(nodes)
    groups = running_totals(tops.select("grp", "hash"), ["grp"], [])
    groups = stage_table(groups.select(F.lit("").alias("grp"), F.lit(tops.count()).cast("long").alias("total"), (F.col("__rank") - 1).alias("place"), "hash", F.col("grp").alias("name")))
    above, root = reduce_levels(groups)
    top = root.select("grp", F.col("hash").alias("root"), F.lit("").alias("subroot"), F.expr(f"cast(array() as {PROOF})").alias("proof"))
    named = prove(above, top, "name string, hash string").select(F.col("name").alias("grp"), "root", F.col("hash").alias("subroot"), "proof")
    out = prove(rounds, stage_table(named), "hash string, doc long, other string")
    return out.select(F.col("doc").alias("id"), F.col("hash").alias("leaf"), "other", "place", "proof", "subroot", "root")


def fold(leaf: Column, proof: Column) -> Column:
    """Root that a leaf and its siblings give."""
    return F.aggregate(proof, leaf, lambda acc, p: F.sha2(F.concat(p["left"], acc, p["right"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["left"], p["right"])), "").cast("binary"), 256)


UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, digest(*fields, F.translate("text", UPPER, SMALL)))
    rows = manifest(documents, digest(*fields, F.col("text")), group=F.col("lang"), id_=F.col("doc_id"), other=tampered)
    rows = rows.withColumn("folded_root", fold(F.coalesce("other", "leaf"), F.col("proof")))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

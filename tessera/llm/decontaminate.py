"""Benchmark decontamination with a distributed positional inverted index.

* **Index.**  One pass over the whole texts stores, per training document, the postings
  (term, position) of the terms that the test items use.  Terms reach the tasks as a bitmap
  of bounded size (at most ``2**FILTER_BITS`` bits, 8 MB; see ``bitmap``), whatever the size of the benchmark: false
  positives only add postings.  For exact phrases a posting matters only inside a run of at
  least ``shortest window`` indexed terms, so all others are left out (lossless).
* **Search.**  For every window of an item the rarest term (by its postings) gives the
  candidate starts (position - offset); the offset-adjusted lists of the other terms are
  then intersected by one equi-join on (document, term, position); a start survives when
  every offset matched.  ``slop`` > 0 lets each term lie that many positions off (proximity).
* **Skew.**  A hot term or passage is spread by a salt derived from the posting's document;
  the search side is repeated once per salt (it has one row per window).

Terms are compared by 64-bit hashes.  Null texts have no words.  Items without words or
without an id take no part.  Rows with equal ids stay separate rows.  An empty benchmark
leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import forget, ship_package, stage_table
from .bitmap import drop_rows, identified, in_bitmap, make_bitmap
from .textnum import Words, alnum_words, blocks, docs, lists, release

SALTS = 16


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(alnum_words(), lower=True)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi, buf, offs in blocks(batch):
                start, end, owner = words.bounds(buf, offs)
                h = words.hashes(buf, start, end).view(np.int64)
                out_id, out = [], []
                cut = np.searchsorted(owner, np.arange(hi - lo + 1))
                for d in range(hi - lo):
                    t = h[cut[d]:cut[d + 1]]
                    for s in range(max(1, len(t) - window + 1) if len(t) else 0):
                        out_id.append(ids[lo + d])
                        out.append(t[s:s + window].tolist())
                yield pa.RecordBatch.from_arrays([pa.array(out_id, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["item_id", "terms"])
    return run


def _postings(shared, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        words, bitmap = Words(alnum_words(), lower=True), shared.value
        for batch in batches:
            ids, th = batch.column(0), batch.column(1)
            for lo, hi, buf, offs in blocks(batch):
                start, end, owner = words.bounds(buf, offs)
                h = words.hashes(buf, start, end)
                count = np.bincount(owner, minlength=hi - lo)
                first = np.concatenate([[0], np.cumsum(count)])
                known = in_bitmap(bitmap, h)
                if least > 1 and len(known):  # runs of known terms inside one text
                    breaks = ~known
                    breaks[1:] |= owner[1:] != owner[:-1]
                    run_id = np.cumsum(breaks)
                    size = np.bincount(run_id, weights=known).astype(np.int64)
                    known &= size[run_id] >= least
                at = np.flatnonzero(known)
                held = np.searchsorted(at, first)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), th.slice(lo, hi - lo), pa.array(count.astype(np.int64)),
                     lists(held, pa.array(h[at].view(np.int64))),
                     lists(held, pa.array((at - first[owner[at]]).astype(np.int32)))],
                    ["id", "th", "n_words", "terms", "places"])
    return run


def positional_index(documents: DataFrame, terms: DataFrame, least: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored index (uid, id, th, n_words, terms, places): one row per document with its postings
    of the given ``term`` hashes that lie in runs of at least ``least`` of them.  ``uid`` tells
    rows with equal ids apart."""
    spark = documents.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(make_bitmap(terms))
    rows = identified(documents, id_col, text_col).mapInArrow(
        _postings(shared, least), "id long, th long, n_words long, terms array<long>, places array<int>")
    index = stage_table(rows.withColumn("uid", F.monotonically_increasing_id()))
    forget(shared)
    return index


def phrase_matches(index: DataFrame, windows: DataFrame, slop: int = 0) -> DataFrame:
    """(uid, start, wid) of every occurrence of the windows (wid, terms) in the index; with
    ``slop`` each term may lie that many positions off its place (start is where the rarest
    term puts it)."""
    post = index.select("uid", F.explode(F.arrays_zip("terms", "places")).alias("p")).select("uid", F.col("p.terms").alias("term"), F.col("p.places").alias("pos"))
    salt = F.pmod(F.xxhash64("uid"), F.lit(SALTS)).cast("int")
    freq = post.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    parts = windows.select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
    ranked = parts.join(freq, "term").groupBy("wid", "len").agg(
        F.count(F.lit(1)).alias("found"), F.min(F.struct("n", "off", "term")).alias("r"))
    # a window with a term that has no postings occurs nowhere
    rare = ranked.filter(F.col("found") == F.col("len")).select("wid", "len", F.col("r.off").alias("off"), F.col("r.term").alias("term"))
    rare = rare.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cand = (post.withColumn("salt", salt).join(rare, ["term", "salt"])
            .select("wid", "len", "uid", (F.col("pos") - F.col("off")).alias("start")))
    if slop == 0:
        cand = cand.filter(F.col("start") >= 0)
    cand = cand.distinct()
    want = cand.join(windows.select("wid", F.posexplode("terms").alias("off", "term")), "wid")
    if slop:
        near = post.select("uid", "term", F.explode(F.sequence(F.col("pos") - slop, F.col("pos") + slop)).alias("pos")).distinct()
    else:
        near = post
    hit = want.withColumn("pos", F.col("start") + F.col("off")).join(near, ["uid", "term", "pos"])
    return (hit.groupBy("wid", "len", "uid", "start").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") == F.col("len")).select("uid", "start", "len", "wid"))


def contamination(documents: DataFrame, items: DataFrame, *, window: int = 13, slop: int = 0, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document: id, th (text hash), n_words, n_hit (words inside any occurrence of
    a window), items (sorted ids of items with occurring windows), contaminated (n_hit > 0 and
    20 * n_hit >= n_words).  ``slop`` > 0 counts proximity matches as occurrences too."""
    spark = documents.sparkSession
    ship_package(spark)
    tests = docs(items, item_id_col, item_text_col).filter(F.col("id").isNotNull())
    wins = stage_table(tests.mapInArrow(_item_windows(window), "item_id long, terms array<long>").distinct()
                       .withColumn("wid", F.xxhash64("terms")))
    least = 1 if slop else (wins.agg(F.min(F.size("terms"))).first()[0] or window)
    index = positional_index(documents, wins.select(F.explode("terms").alias("term")).distinct(), least, id_col, text_col)
    occ = stage_table(phrase_matches(index, wins.select("wid", "terms").dropDuplicates(["wid"]), slop))
    # union of the covered word ranges: each start covers up to the next start at most; at one
    # start the longest window counts
    at = occ.groupBy("uid", "start").agg(F.max(F.col("start") + F.col("len")).alias("end"))
    w = Window.partitionBy("uid").orderBy("start")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(reach, F.col("start"))))
    hits = at.select("uid", new.alias("new")).groupBy("uid").agg(F.sum("new").alias("n_hit"))
    named = (occ.select("uid", "wid").distinct().join(wins.select("wid", "item_id"), "wid").select("uid", "item_id").distinct()
             .groupBy("uid").agg(F.array_sort(F.collect_list(F.col("item_id").cast("string"))).alias("items")))
    out = index.select("uid", "id", "th", "n_words").join(hits, "uid", "left").join(named, "uid", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("id", "th", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"))


def decontaminate(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row; options as in
    ``contamination``."""
    return contamination(documents, items, **options).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


def drop_contaminated(documents: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``documents``, all columns, that are not contaminated."""
    ids = {k: v for k, v in options.items() if k in ("id_col", "text_col")}
    bad = contamination(documents, items, **options).filter("contaminated").select("id", "th", F.lit(False).alias("keep")).distinct()
    return drop_rows(documents, stage_table(bad), **ids)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))

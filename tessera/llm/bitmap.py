"""Lossless row filters of fixed size.

A set of 64-bit hashes becomes a bitmap (one bit a hash) of a bounded number of bits, fewer for
small sets.  It can be broadcast whatever the set's size; a false positive lets a row through to
an exact join, and no member is ever missed.  A broadcast lies on the disk of the driver and of
each executor until it is destroyed.  ``drop_rows`` uses one to take rows out of a table of texts without
shuffling the texts that stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

FILTER_BITS = 26
#: Bits for each bit that is set; a bitmap has fewer only at its full size.
SPARE = 256
LEAST_ID = -(1 << 63)


def make_bitmap(terms: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of 2^bits bits, or fewer for small sets, with the bit of each long in the column
    ``term`` set; at most 2^bits / 64 rows reach the driver."""
    slot = F.col("term").bitwiseAND(F.lit((1 << bits) - 1))
    word = (terms.select(F.shiftright(slot, 6).alias("w"), F.expr("shiftleft(1L, cast(term & 63 as int))").alias("b"))
            .groupBy("w").agg(F.bit_or("b").alias("b")))
    got = word.toArrow()
    out = np.zeros((1 << bits) // 64, np.uint64)
    out[got["w"].to_numpy()] = got["b"].to_numpy().view(np.uint64)
    return _fitted(out)


def _fitted(bitmap: np.ndarray) -> np.ndarray:
    """The bitmap in as few bits as leave SPARE for each that is set: a hash's place in half as
    many bits is its place without the highest bit, so halves are laid over each other."""
    most = SPARE * int(np.bitwise_count(bitmap).sum())
    while len(bitmap) > 1 and len(bitmap) * 32 >= most:
        half = len(bitmap) // 2
        bitmap = bitmap[:half] | bitmap[half:]
    return bitmap


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Membership of uint64 hashes."""
    slot = h & np.uint64(len(bitmap) * 64 - 1)
    return ((bitmap[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)


def identified(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, th, text): ``th`` is the 64-bit hash of the text (null as empty); (id, th) names a
    text, so repeated rows of one id and text are one."""
    text = F.col(f"`{text_col}`").cast("string")
    return documents.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("th"), text.alias("text"))


def with_mark(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """All columns, then __id (null as the least long), __th and __mark (hash of both)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = documents.withColumns({"__id": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LEAST_ID)), "__th": F.xxhash64(text)})
    return rows.withColumn("__mark", F.xxhash64("__id", "__th"))


def only_marked(shared, inside: bool):
    """The rows of ``with_mark`` that may be in the bitmap (``inside``), or surely are not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            mark = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            yield batch.filter(pa.array(in_bitmap(bits, mark) == inside))
    return run


def marked(documents: DataFrame, named: DataFrame, id_col: str, text_col: str, bits: int = FILTER_BITS):
    """(broadcast bitmap of the texts that ``named`` (id, th, ...) holds, ``with_mark`` rows, the
    named keys as (__id, __th, ...))."""
    ship_package(documents.sparkSession)
    keys = named.withColumnsRenamed({"id": "__id", "th": "__th"}).withColumn("__id", F.coalesce("__id", F.lit(LEAST_ID)))
    shared = documents.sparkSession.sparkContext.broadcast(make_bitmap(keys.select(F.xxhash64("__id", "__th").alias("term")), bits))
    return shared, with_mark(documents, id_col, text_col), keys


def plain_names(documents: DataFrame, *names: str | None) -> tuple[DataFrame, list[str | None]]:
    """``documents`` with its columns named c0, c1, ..., so that no name clashes with those used
    inside, and the new names of some of them."""
    new = [f"c{i}" for i in range(len(documents.columns))]
    place = {c: n for c, n in zip(documents.columns, new)}
    return documents.toDF(*new), [None if n is None else place[n] for n in names]


def free_name(documents: DataFrame, name: str) -> str:
    """A column name that ``documents`` does not have."""
    taken = {c.lower() for c in documents.columns}
    while name.lower() in taken:
        name += "_"
    return name


def drop_rows(documents: DataFrame, named: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` without the rows that ``named`` (id, th, keep) holds with keep = false; of
    repeated rows that it holds with keep = true one stays.  All columns are kept."""
    plain, (id_col, text_col) = plain_names(documents, id_col, text_col)
    shared, rows, keys = marked(plain, named, id_col, text_col)
    cols = [F.col(c) for c in plain.columns]
    clean = rows.mapInArrow(only_marked(shared, False), rows.schema).select(*cols)
    rest = rows.mapInArrow(only_marked(shared, True), rows.schema).join(keys, ["__id", "__th"], "left")
    others = rest.filter("keep is null").select(*cols)
    kept = rest.filter("keep").dropDuplicates(["__id", "__th"]).select(*cols)
    return clean.unionAll(others).unionAll(kept).toDF(*documents.columns)

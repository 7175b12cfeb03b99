"""Scans and coercion (IO1-IO3).

The reference's only source is one CSV with a header row; the test tables are Parquet.
Schemas are declared up front (no inference pass over the data at scale); a dirty
numeric column is read as string and coerced with ``try_cast`` (a bad cell -> NULL, as
pandas ``to_numeric(errors='coerce')``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.kinds import nan_to_null, q

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test tables (Parquet); NaN cells become NULL, as in every source."""
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, infer: bool = False) -> DataFrame:
    """CSV scan; a declared schema is the default, inference only on request."""
    reader = spark.read.option("header", header)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return nan_to_null(reader.csv(path))


def coerce_numeric(df: DataFrame, cols: Sequence[str], to: str = "double") -> DataFrame:
    """Unparsable or blank strings become NULL (never an error under ANSI mode)."""
    return df.withColumns({c: F.expr(f"try_cast(trim(`{c}`) AS {to})") for c in cols})


def split_label(df: DataFrame, label: str, drop: Sequence[str] = ()) -> DataFrame:
    """Drop identifier-like columns but keep the label as a column (no separate vector)."""
    return df.drop(*[c for c in drop if c != label])


def project(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[q(c) for c in cols])

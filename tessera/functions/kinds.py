"""Column kinds (numeric / categorical / binary), NaN normalisation and schema alignment."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)
INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL_TYPES = (T.FloatType, T.DoubleType)


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, NUMERIC_TYPES)


def is_categorical(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.CharType, T.VarcharType))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_categorical(f.dataType) and f.name not in ex]


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Float NaN becomes SQL NULL so that every statistic treats it as missing."""
    fr = {f.name for f in df.schema.fields if isinstance(f.dataType, FRACTIONAL_TYPES)}
    cols = [c for c in (columns or list(fr)) if c in fr]
    if not cols:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols})


def align(df: DataFrame, schema: T.StructType, fill=0) -> DataFrame:
    """Project ``df`` onto ``schema``'s columns in order; absent columns become ``fill``."""
    have = set(df.columns)
    out = []
    for f in schema.fields:
        if f.name in have:
            out.append(F.col(f.name))
        else:
            out.append(F.lit(fill).cast(f.dataType).alias(f.name))
    return df.select(*out)


def q(name: str) -> Column:
    """Column by (possibly odd) name, backtick-quoted."""
    return F.col(f"`{name}`")


def sql_name(name: str) -> str:
    """Backtick-quoted name for SQL text.  Aggregates over hundreds of columns are built as
    text: one call to the JVM for all of them instead of several for every operator."""
    return f"`{name}`"


def sql_double(value: float | None) -> str:
    """Double literal for SQL text (exact; also for infinities and NaN)."""
    return "cast(null as double)" if value is None else f"cast('{float(value)!r}' as double)"

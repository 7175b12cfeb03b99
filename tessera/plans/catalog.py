"""Registry of named queries: each fits an operator on the train part of a fixture built
from the driver's tables and returns the transformed WHOLE table (train and test rows),
so the amount of work grows with the tables.

``QUERIES[name] = fn(spark, sf_dir) -> DataFrame``; ``ORACLES[name] = DuckDB SQL`` when the
operator has an exact SQL meaning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def expand_sig(sql: str) -> str:
    """Expand every ``sig(expr)`` in oracle SQL into the significant-digit rounding."""
    from .oracle import sig
    out, i = [], 0
    while True:
        j = sql.find("sig(", i)
        if j < 0:
            return "".join(out) + sql[i:]
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 4])
            i = j + 4
            continue
        k, depth = j + 4, 1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(sig(expand_sig(sql[j + 4:k - 1])))
        i = k


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = expand_sig(sql)
        return fn
    return deco


SIG = 9  # significant digits kept in every double a query returns (same rule in oracle.sig)


def r6(c: str | Column, name: str | None = None) -> Column:
    """Round a double to SIG significant digits (scale-free, so sums accumulated in a
    different order by another engine still agree); x / 10^e with an exact power of ten."""
    col = (F.col(f"`{c}`") if isinstance(c, str) else c).cast("double")
    e = F.floor(F.log10(F.abs(col)))
    p = F.pow(F.lit(10.0), F.abs(e))
    scaled = F.when(e >= 0, col / p).otherwise(col * p)
    # floor(x*10^k + 0.5) / 10^k: plain IEEE arithmetic, bit-identical in any engine
    k = F.lit(float(10 ** (SIG - 1)))
    r = F.floor(scaled * k + F.lit(0.5)).cast("double") / k
    back = F.when(e >= 0, r * p).otherwise(r / p)
    out = F.when(col.isNull() | (col == 0), col).otherwise(back)
    return out.alias(name or (c if isinstance(c, str) else "value"))


def f1(spark: SparkSession, sf: str) -> DataFrame:
    return fx.with_split(fx.customer_features(spark, sf))


def f3(spark: SparkSession, sf: str) -> DataFrame:
    return fx.with_split(fx.events_dirty(spark, sf))


def f5(spark: SparkSession, sf: str) -> DataFrame:
    return fx.with_split(fx.planted(spark, sf))


def train_of(df: DataFrame) -> DataFrame:
    return df.filter(~F.col("is_test"))


# Importing the query modules fills the registry.
from . import q_core, q_encode, q_models, q_neighbors, q_outliers, q_profile, q_resample, q_select  # noqa: E402,F401

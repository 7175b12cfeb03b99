"""Fit/transform protocol shared by every operator.

``Op.fit(train)`` runs the (small) aggregate jobs and returns a ``Fitted`` holding only
bounded state (literals per column, or a size-checked dictionary table).
``Fitted.transform(df)`` is lazy: it adds/replaces columns with expressions and
broadcast lookups, never triggers a job, and therefore also works on a streaming
DataFrame.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.kinds import q


def count_hits(df: DataFrame, hits: dict[str, str], counts: Observation | None) -> DataFrame:
    """``df`` without the boolean columns ``hits`` (name -> column).  ``counts``, if given,
    gathers the true rows per name while ``df`` runs in the caller's next action: no further
    job.  Stages that Spark runs again after losing an executor may be counted twice."""
    if counts is not None and hits:
        df = df.observe(counts, *[F.count_if(q(h)).alias(name) for name, h in hits.items()])
    return df.drop(*hits.values())


class Fitted:
    """Fitted state; ``transform`` must be lazy and keep the row count."""

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.transform(df)


class Op:
    """An operator with parameters; ``fit`` returns a ``Fitted``."""

    def fit(self, df: DataFrame) -> Fitted:  # pragma: no cover - interface
        raise NotImplementedError

    def fit_transform(self, df: DataFrame) -> tuple[Fitted, DataFrame]:
        f = self.fit(df)
        return f, f.transform(df)

"""Small relational helpers for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def strongest_source(df: DataFrame, keys: list[str], strength: list[str]) -> DataFrame:
    """Per key, the ``strength`` columns of the strongest row; combines before the shuffle."""
    best = df.groupBy(*keys).agg(F.max(F.struct(*strength)).alias("__best"))
    return best.select(*keys, *[F.col(f"__best.{s}").alias(s) for s in strength])

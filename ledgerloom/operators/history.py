"""Last write wins, latest rows and capped ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first in ``order``.

    max_by would carry whole rows through the map side; a window that keeps one
    row per key lets Spark drop the others before the exchange.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def upsert(table: DataFrame, changes: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """``table`` after ``changes``: per key the row with the highest version, a change winning a tie."""
    both = table.withColumn("__new", F.lit(0)).unionByName(changes.withColumn("__new", F.lit(1)))
    return latest(both, keys, [F.col(version).desc_nulls_last(), F.col("__new").desc()]).drop("__new")


def capped(df: DataFrame, classes: Sequence[str], order: Sequence[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows of each class. Spark turns the filter into a per-task limit before the exchange."""
    w = Window.partitionBy(*classes).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= cap)

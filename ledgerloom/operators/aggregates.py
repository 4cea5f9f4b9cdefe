"""Grouped counts in the shapes that reports take."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def field_counts(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, value, n) over all the fields in one pass; null counts as "unknown"."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f).cast("string"), F.lit("unknown")).alias("value")) for f in fields])).alias("p")
    return df.select(pairs).groupBy("p.field", "p.value").agg(F.count("*").alias("n"))


def count_deltas(current: DataFrame, previous: DataFrame, fields: Sequence[str]) -> DataFrame:
    """(field, value, current, previous, delta) over the values of either side."""
    a = field_counts(current, fields).withColumnRenamed("n", "current")
    b = field_counts(previous, fields).withColumnRenamed("n", "previous")
    both = a.join(b, ["field", "value"], "full_outer").na.fill(0, ["current", "previous"])
    return both.withColumn("delta", F.col("current") - F.col("previous"))


def composition(df: DataFrame, sets: Sequence[Sequence[str]], flag: str) -> DataFrame:
    """Rows, flagged rows and their share for each grouping set, in one pass."""
    names = list(dict.fromkeys(c for s in sets for c in s))
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in names]).agg(
        F.grouping_id().cast("long").alias("grouping"),
        F.count("*").alias("n"),
        F.count_if(F.col(flag)).alias("flagged"),
        F.bround(F.count_if(F.col(flag)) / F.count("*"), 6).alias("share"),
    )


def nested_counts(df: DataFrame, outer: str, inner: str) -> DataFrame:
    """(outer, counts): a map of inner value to count, which holds no more entries than there are inner values."""
    per = df.filter(F.col(inner).isNotNull()).groupBy(outer, inner).agg(F.count("*").alias("n"))
    return per.groupBy(outer).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(inner, "n")))).alias("counts"))


def flag_counts(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """(name, n): rows that set each of the boolean columns, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f)).alias(f) for f in flags])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(f).alias("name"), F.col(f).alias("n")) for f in flags])).alias("c")).select("c.*")

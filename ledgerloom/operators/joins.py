"""Joins with the semantics that a dataset build needs beyond inner and outer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


NUMBERS = 1 << 20


def first_match(df: DataFrame, value: Column, dimension: DataFrame, labels: Column, order: str, take: str) -> DataFrame:
    """``df`` with ``take`` of the first dimension row, by ``order``, that has ``value`` among its labels."""
    exploded = dimension.select(F.explode(labels).alias("__label"), order, take).filter(F.col("__label").isNotNull())
    first = exploded.groupBy("__label").agg(F.min_by(take, order).alias(take))
    return df.withColumn("__label", value).join(first, "__label", "left").drop("__label")


def required(left: DataFrame, right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(joined, misses): an inner join and the left rows that it loses, which callers treat as violations."""
    return left.join(right, list(on)), left.join(right.select(*on), list(on), "left_anti")


def presence(df: DataFrame, key: str, among: dict[str, DataFrame], otherwise: str) -> DataFrame:
    """(key, reason): the first of the named frames that holds the key."""
    reason = None
    for name, other in among.items():
        marks = other.select(F.col(key)).distinct().withColumn(f"__{name}", F.lit(True))
        df = df.join(marks, key, "left")
        reason = F.when(F.col(f"__{name}"), name) if reason is None else reason.when(F.col(f"__{name}"), name)
    return df.withColumn("reason", reason.otherwise(otherwise)).drop(*[f"__{n}" for n in among])


def either_key(left: DataFrame, right: DataFrame, keys: Sequence[tuple[str, str]], take: str) -> DataFrame:
    """``take`` of the right row that matches by the first key that matches at all.

    Two equi-joins instead of one with OR, which would compare all pairs.
    """
    found = []
    for i, (l, r) in enumerate(keys):
        side = right.filter(F.col(r).isNotNull()).groupBy(F.col(r).alias(l)).agg(F.min(take).alias(f"__m{i}"))
        left = left.join(side, l, "left")
        found.append(F.col(f"__m{i}"))
    return left.withColumn(take, F.coalesce(*found)).drop(*[f"__m{i}" for i in range(len(keys))])


def range_lookup(facts: DataFrame, key: str, at: str, states: DataFrame, since: str, take: Sequence[str], bucket: str = "month") -> DataFrame:
    """``facts`` with the latest state of the key at or before ``at``; states have one row a (key, time).

    One union and a window on (key, ``bucket`` of time): linear, where a range
    join is not, and a key with a third of all rows is as many tasks as it has
    buckets. What holds when a bucket begins is the last state of the buckets
    before, one row each. Numbers have buckets of ``NUMBERS``.
    """
    value = F.struct(*[F.col(c) for c in take])
    shared = facts.withColumns({"__t": F.col(at), "__fact": F.lit(1), "__v": F.lit(None).cast(states.select(value.alias("v")).schema["v"].dataType)})
    marks = states.select(F.col(key), F.col(since).alias("__t"), F.lit(0).alias("__fact"), value.alias("__v"))
    both = shared.unionByName(marks, allowMissingColumns=True)
    is_time = both.schema["__t"].dataType.typeName() in ("timestamp", "timestamp_ntz", "date")
    both = both.withColumn("__b", F.date_trunc(bucket, "__t") if is_time else F.floor(F.col("__t") / NUMBERS))
    inside = Window.partitionBy(key, "__b").orderBy("__t", "__fact").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__in", F.last(F.when(F.col("__fact") == 0, F.col("__v")), ignorenulls=True).over(inside)).filter("__fact = 1")
    # buckets that hold a fact or a state, with the last state before each
    per = both.groupBy(key, "__b").agg(F.max_by("__v", F.when(F.col("__fact") == 0, F.col("__t"))).alias("__end"))
    before = Window.partitionBy(key).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    carried = per.select(F.col(key), "__b", F.last("__end", ignorenulls=True).over(before).alias("__carried")).filter("__carried IS NOT NULL")
    out = found.join(carried, [key, "__b"], "left").withColumn("__state", F.coalesce("__in", "__carried"))
    return out.select(*facts.columns, *[F.col(f"__state.{c}").alias(c) for c in take])

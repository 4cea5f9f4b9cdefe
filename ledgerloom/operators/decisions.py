"""Rows beside the decisions on them: precedence, audit and progress."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge(items: DataFrame, key: str, decisions: Sequence[tuple[str, DataFrame]], otherwise: tuple[str, str]) -> DataFrame:
    """(key, decision_source, outcome, detail): for each item the first of the named frames that decides it.

    Each frame has (key, outcome, detail) with a key once; ``otherwise`` is the
    (source, outcome) of items that none decides. One left join a frame.
    """
    source = outcome = detail = None
    joined = items.select(key)
    for i, (name, df) in enumerate(decisions):
        side = df.select(key, F.struct("outcome", "detail").alias(f"__{i}"))
        joined = joined.join(side, key, "left")
        has, value = F.col(f"__{i}").isNotNull(), F.col(f"__{i}")
        source = F.when(has, name) if source is None else source.when(has, name)
        outcome = F.when(has, value["outcome"]) if outcome is None else outcome.when(has, value["outcome"])
        detail = F.when(has, value["detail"]) if detail is None else detail.when(has, value["detail"])
    return joined.select(key, source.otherwise(otherwise[0]).alias("decision_source"), outcome.otherwise(otherwise[1]).alias("outcome"), detail.alias("detail"))


def unknown_targets(decisions: DataFrame, items: DataFrame, key: str, second: str) -> DataFrame:
    """(key, second, reason): decisions on unknown items, and those whose second id is another item's.

    ``items`` has both ids, each once.
    """
    by_key = items.select(key, F.col(second).alias("__by_key"))
    by_second = items.select(F.col(second), F.col(key).alias("__by_second"))
    joined = decisions.select(key, second).join(by_key, key, "left").join(by_second, second, "left")
    known = F.col("__by_key").isNotNull()
    reason = (
        F.when(~known & F.col("__by_second").isNull(), "unknown_item")
        .when(~known, "other_item")
        .when(F.col(second).isNotNull() & (F.col("__by_key") != F.col(second)), "mismatch")
    )
    return joined.withColumn("reason", reason).filter("reason IS NOT NULL").select(key, second, "reason")


def overlaps(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """(key, frames): keys that several frames hold, which must have none in common."""
    marked = None
    for name, df in frames.items():
        part = df.filter(F.col(key).isNotNull()).select(key).distinct().withColumn("__in", F.lit(name))
        marked = part if marked is None else marked.unionByName(part)
    # no more names a key than there are frames
    return marked.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list("__in")), ",").alias("frames"), F.count("*").alias("__n")).filter("__n > 1").drop("__n")


def own(items: DataFrame, decisions: DataFrame, key: str, reviewer_col: str, reviewer: str) -> DataFrame:
    """``items`` beside one reviewer's decisions on them; other reviewers' are not seen."""
    mine = decisions.filter(F.col(reviewer_col) == reviewer).select(key, F.lit(True).alias("decided")).distinct()
    return items.join(mine, key, "left").withColumn("decided", F.coalesce("decided", F.lit(False)))


def progress(items: DataFrame, decisions: DataFrame, key: str, group: str) -> DataFrame:
    """(group, total, decided, open) of the items."""
    marks = decisions.select(key).distinct().withColumn("__d", F.lit(True))
    done = F.count_if(F.coalesce("__d", F.lit(False)))
    return items.join(marks, key, "left").groupBy(group).agg(F.count("*").alias("total"), done.alias("decided"), (F.count("*") - done).alias("open"))


def open_batch(batches: DataFrame, batch_id: str, at: str) -> DataFrame:
    """``batches`` (batch_id, active, opened_at) with a new active one, all others closed; a batch of that id is opened again."""
    others = batches.filter(F.col("batch_id") != batch_id).withColumn("active", F.lit(False))
    new = batches.sparkSession.createDataFrame([(batch_id, True, at)], "batch_id string, active boolean, opened_at string")
    return others.unionByName(new.select("batch_id", "active", F.col("opened_at").cast(batches.schema["opened_at"].dataType).alias("opened_at")))


def items_of_active(batches: DataFrame, items: DataFrame, order: str) -> DataFrame:
    """Items of the active batch, with ``place`` by ``order`` within the batch."""
    active = F.broadcast(batches.filter("active").select("batch_id").limit(1))  # one row
    mine = items.join(active, "batch_id", "left_semi")
    return mine.withColumn("place", F.row_number().over(Window.partitionBy("batch_id").orderBy(order)) - 1)

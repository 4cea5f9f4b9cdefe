"""Checks inside nested records: links between their parts, offsets and geometry.

Each takes a frame with a key and nested columns and returns violations, so a
record with thousands of parts is spread over rows before it is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_parts(df: DataFrame, key: str, part_ids: Column, reason: str) -> DataFrame:
    """(key, part, reason): ids that one record gives to several parts."""
    parts = df.select(key, F.explode(part_ids).alias("part"))
    return parts.groupBy(key, "part").agg(F.count("*").alias("n")).filter("n > 1").select(key, "part", F.lit(reason).alias("reason"))


def broken_links(df: DataFrame, key: str, links: Column, targets: Column, reason: str) -> DataFrame:
    """(key, part, reason): links to a part that the same record lacks."""
    missing = F.array_except(F.coalesce(links, F.array().cast("array<string>")), F.coalesce(targets, F.array().cast("array<string>")))
    return df.select(key, F.explode(F.array_compact(missing)).alias("part")).withColumn("reason", F.lit(reason))


def bad_offsets(df: DataFrame, key: str, spans: str, reason: str = "bad_offsets") -> DataFrame:
    """(key, part, reason) of spans <id, start, end, text> that end before they start or beyond their text."""
    s = df.select(key, F.explode(spans).alias("s"))
    bad = (F.col("s.start") < 0) | (F.col("s.end") < F.col("s.start")) | (F.col("s.end") > F.length("s.text"))
    return s.filter(F.coalesce(bad, F.lit(True))).select(key, F.col("s.id").alias("part"), F.lit(reason).alias("reason"))


def incomplete_geometry(df: DataFrame, key: str, regions: str, reason: str = "incomplete_geometry") -> DataFrame:
    """(key, part, reason) of regions <id, kind, box, polygon> without what their kind needs."""
    r = df.select(key, F.explode(regions).alias("r"))
    fine = F.when(F.col("r.kind") == "box", F.size("r.box") == 4).when(F.col("r.kind") == "polygon", F.size("r.polygon") >= 3).when(F.col("r.kind") == "none", F.col("r.box").isNull() & F.col("r.polygon").isNull())
    return r.filter(~F.coalesce(fine, F.lit(False))).select(key, F.col("r.id").alias("part"), F.lit(reason).alias("reason"))


def uncovered(df: DataFrame, flags: str) -> DataFrame:
    """(name): keys of a map of booleans that no row sets."""
    return df.select(F.explode(flags).alias("name", "on")).groupBy("name").agg(F.bool_or(F.coalesce("on", F.lit(False))).alias("covered")).filter("NOT covered").select("name")


def keep_members(df: DataFrame, key: str, column: str, field: str, known: DataFrame, known_key: str) -> DataFrame:
    """``df`` with the structs of ``column`` whose ``field`` is among the known keys, in their order; a null list becomes an empty one.

    ``key`` names rows once. Members are spread over rows for the join, so the
    known keys may be any number.
    """
    spread = df.select(F.col(key), F.posexplode(column).alias("__at", "__m")).withColumn("__k", F.col(f"__m.{field}"))
    kept = spread.join(known.select(F.col(known_key).alias("__k")).distinct(), "__k", "left_semi")
    lists = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("__at", "__m"))).alias("__l"))
    empty = F.array().cast(df.schema[column].dataType)
    return df.join(lists, key, "left").withColumn(column, F.coalesce(F.transform("__l", lambda x: x["__m"]), empty)).drop("__l")

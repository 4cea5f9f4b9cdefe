"""Hash splits by group, and the check that no group spans several splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import stable_bucket
from ledgerloom.operators.skew import lookup
from ledgerloom.storage import materialize


def pick_split(group: Column, shares: Sequence[tuple[str, float]]) -> Column:
    """The split of a group by its bucket; a projection, so nothing is shuffled."""
    bucket, low, picked = stable_bucket(group), 0.0, None
    for name, share in shares[:-1]:
        low += share
        picked = F.when(bucket < low, name) if picked is None else picked.when(bucket < low, name)
    return picked.otherwise(shares[-1][0])


def leakage(df: DataFrame, kinds: Sequence[str], split: str) -> DataFrame:
    """(kind, group_id, splits, members): groups of any kind whose members are in several splits."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("group_id")) for k in kinds])).alias("g")
    long = df.filter(F.col(split).isNotNull()).select(pairs, F.col(split).alias("split")).select("g.*", "split").filter(F.col("group_id").isNotNull())
    per = long.groupBy("kind", "group_id", "split").agg(F.count("*").alias("n"))
    found = per.groupBy("kind", "group_id").agg(F.array_join(F.array_sort(F.collect_list("split")), ",").alias("splits"), F.sum("n").alias("members"), F.count("*").alias("k"))
    return found.filter("k > 1").drop("k")


def group_by_precedence(df: DataFrame, fingerprint: str, source_group: str, own: Column) -> DataFrame:
    """``df`` with ``split_group`` and ``group_kind``: the cluster of equal fingerprints, else the source group of several rows, else the row's own.

    Both counts are reduced map-side and looked up, so a fingerprint or group
    with a third of all rows is no larger a task than others.
    """
    df = materialize(df, "to-group")
    clusters = df.filter(F.col(fingerprint).isNotNull()).groupBy(fingerprint).agg(F.count("*").alias("__c")).filter("__c > 1")
    groups = df.filter(F.length(F.col(source_group)) > 0).groupBy(source_group).agg(F.count("*").alias("__g")).filter("__g > 1")
    n = df.count()
    joined = lookup(lookup(df, clusters, fingerprint, n, "left"), groups, source_group, n, "left")
    kind = F.when(F.col("__c").isNotNull(), "cluster").when(F.col("__g").isNotNull(), "group").otherwise("own")
    group = F.when(kind == "cluster", F.concat(F.lit("cluster:"), F.substring(fingerprint, 1, 16))).when(kind == "group", F.concat(F.lit("group:"), F.col(source_group))).otherwise(own)
    return joined.withColumns({"split_group": group, "group_kind": kind}).drop("__c", "__g")

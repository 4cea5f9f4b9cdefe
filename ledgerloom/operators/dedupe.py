"""Exact duplicates, near-duplicate signatures and source groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup


def priority(col: Column, ordered: Sequence[str]) -> Column:
    """Position in a list of preferred values; all others last."""
    at = F.array_position(F.array(*[F.lit(v) for v in ordered]), col) if ordered else F.lit(0)
    return F.when(at > 0, at).otherwise(len(ordered) + 1)


def canonical_rows(df: DataFrame, fingerprint: str, key: str, order: Sequence[str]) -> DataFrame:
    """``df`` with the canonical row of each fingerprint marked: the first by ``order``, then ``key``.

    Adds ``cluster_size`` and ``is_canonical``. Sizes and best rows are reduced
    map-side and looked up, so a text that fills a third of the table never
    meets in one task, as it would in a window.
    """
    stats = df.groupBy(fingerprint).agg(F.count("*").alias("cluster_size"), F.min(F.struct(*order, key)).alias("__best"))
    marked = lookup(df, stats, fingerprint)
    return marked.withColumn("is_canonical", F.col(key) == F.col(f"__best.{key}")).drop("__best")


def clusters(df: DataFrame, fingerprint: str, key: str, order: Sequence[str]) -> DataFrame:
    """(fingerprint, canonical, n): fingerprints that more than one key has.

    Reduced map-side; members stay rows, so a fingerprint that a third of all
    rows share is no larger than any other here.
    """
    best = F.min(F.struct(*order, key))
    grouped = df.groupBy(fingerprint).agg(F.count("*").alias("n"), best.alias("best"))
    return grouped.filter("n > 1").select(fingerprint, F.col(f"best.{key}").alias("canonical"), "n")


def near_clusters(df: DataFrame, signature: str, fingerprint: str) -> DataFrame:
    """(signature, members, fingerprints): equal signatures over two or more different fingerprints."""
    per = df.filter(F.col(signature).isNotNull()).groupBy(signature, fingerprint).agg(F.count("*").alias("n"))
    return per.groupBy(signature).agg(F.sum("n").alias("members"), F.count("*").alias("fingerprints")).filter("fingerprints > 1")


def shared_keys(df: DataFrame, key: str, least: int = 2) -> DataFrame:
    """(key, members): keys that at least so many rows have."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("members")).filter(F.col("members") >= least)


def item_signature(assets: Column) -> Column:
    """The tuple of an item's asset hashes (structs <hash, preview_hash>), a preview's where the asset has none; null if any lacks both or there is none."""
    each = F.transform(assets, lambda a: F.coalesce(a["hash"], a["preview_hash"]))
    return F.when((F.size(each) > 0) & ~F.exists(each, lambda h: h.isNull()), F.array_join(each, "|"))

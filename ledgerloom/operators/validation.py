"""Checks as frames: a row is a violation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def missing_references(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows of ``child`` whose reference is not null and not in ``parent``."""
    known = parent.select(F.col(key).alias(column)).distinct()
    return child.filter(F.col(column).isNotNull()).join(known, column, "left_anti")


def row_reasons(df: DataFrame, checks: dict[str, Column], name: str = "reasons") -> DataFrame:
    """``df`` with the sorted names of the checks that do not hold; null counts as not holding."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(reason)) for reason, ok in checks.items()]
    return df.withColumn(name, F.array_sort(F.array_compact(F.array(*failed))))


def health(df: DataFrame, group: str, checks: dict[str, Column]) -> DataFrame:
    """(group, n, one column a check, healthy): the rows that pass each check, and whether all pass all."""
    aggs = [F.count_if(F.coalesce(ok, F.lit(False))).alias(name) for name, ok in checks.items()]
    out = df.groupBy(group).agg(F.count("*").alias("n"), *aggs)
    every = F.lit(True)
    for name in checks:
        every = every & (F.col(name) == F.col("n"))
    return out.withColumn("healthy", every)


def conflicting(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """(key, column, n): columns that hold several values for one key."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("p")
    per = df.select(key, pairs).select(key, "p.column", "p.value").distinct()
    return per.groupBy(key, "column").agg(F.count("*").alias("n")).filter("n > 1")


def checksum_status(expected: DataFrame, actual: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, status): ok, mismatch, missing or unexpected."""
    e = expected.select(key, F.col(digest).alias("__e"))
    a = actual.select(key, F.col(digest).alias("__a"))
    status = F.when(F.col("__a").isNull(), "missing").when(F.col("__e").isNull(), "unexpected").when(F.col("__e") == F.col("__a"), "ok").otherwise("mismatch")
    return e.join(a, key, "full_outer").select(key, status.alias("status"))


def unequal(df: DataFrame, keys: Sequence[str], pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(keys, column): rows whose two sides of a named pair differ; null equals only null."""
    names = F.array_compact(F.array(*[F.when(~a.eqNullSafe(b), F.lit(name)) for name, (a, b) in pairs.items()]))
    return df.select(*keys, F.explode(names).alias("column"))


def broken_links(links: dict[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """(link, value): references of all the named links (child, column, parent, key) that lead nowhere, one row each."""
    out = None
    for name, (child, column, parent, key) in links.items():
        part = missing_references(child.select(column), column, parent, key).select(F.lit(name).alias("link"), F.col(column).cast("string").alias("value"))
        out = part if out is None else out.unionByName(part)
    return out


def bad_shares(shares: dict[str, float], places: int = 6) -> list[str]:
    """What is wrong with the shares of splits: negative ones, and a sum that isn't 1."""
    problems = [f"{name} is negative" for name, share in shares.items() if share < 0]
    return problems + ([] if round(sum(shares.values()), places) == 1 else ["shares do not add up to 1"])


def unknown_rows(child: DataFrame, parent: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``child`` whose columns, taken together, ``parent`` has in no row; null equals null."""
    known = parent.select(*[F.col(c).alias(f"__{c}") for c in columns]).distinct()
    same = F.lit(True)
    for c in columns:
        same = same & child[c].eqNullSafe(known[f"__{c}"])
    return child.join(known, same, "left_anti")


def set_problems(expected: Sequence[str], actual: Sequence[str], exact: bool = True) -> list[str]:
    """What is missing from a small set and, if it must be exact, what is too much."""
    problems = [f"missing {x}" for x in expected if x not in set(actual)]
    return problems + [f"unexpected {x}" for x in dict.fromkeys(actual) if exact and x not in set(expected)]

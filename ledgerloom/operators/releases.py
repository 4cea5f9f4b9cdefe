"""A release beside earlier ones: choice of the baseline, reasons, declared counts, versioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.text import natural_key
from ledgerloom.operators.history import capped

#: fixed values: the order of splits in listings; rows without one come last
SPLITS = ("train", "validation", "test")


def instant(col: Column) -> Column:
    """The UTC instant of an ISO text; one without zone is UTC; null if it is none."""
    zoned = col.rlike(r"(Z|[+-]\d\d:?\d\d)$")
    return F.try_to_timestamp(F.when(zoned, F.regexp_replace(col, "Z$", "+00:00")).otherwise(F.concat(col, F.lit("+00:00"))))


def split_rank(col: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(s) for s in SPLITS]), col)
    return F.when(at > 0, at - 1).otherwise(F.lit(len(SPLITS)))


def latest_baseline(releases: DataFrame, version: str, exported_at: str, current: str | None = None) -> DataFrame:
    """The row of the latest other release: those with a time before those without, by time, then by natural order of names."""
    others = releases if current is None else releases.filter(F.col(version) != current)
    rank = F.struct(F.col(exported_at).isNotNull().alias("known"), F.col(exported_at).alias("at"), natural_key(F.col(version)).alias("name"))
    return others.agg(F.max_by(F.struct(*others.columns), rank).alias("r")).filter("r IS NOT NULL").select("r.*")


def count_mismatches(declared: DataFrame, actual: DataFrame, keys: Sequence[str], count: str = "n") -> DataFrame:
    """(keys, declared, actual) where the two sides differ; a side without the keys counts 0."""
    d = declared.select(*keys, F.col(count).alias("declared"))
    a = actual.select(*keys, F.col(count).alias("actual"))
    both = d.join(a, list(keys), "full_outer").na.fill(0, ["declared", "actual"])
    return both.filter("declared <> actual")


def balanced_top(df: DataFrame, synthetic: str, order: Sequence[Column], most_real: int, most_synthetic: int) -> DataFrame:
    """The first ``most_real`` real rows, and of the synthetic ones as many as ``most_synthetic`` and twice the real ones allow.

    A limit by design. Each side is a top-k, so no more than the limits leave a task.
    """
    if min(most_real, most_synthetic) < 0:
        raise ValueError("limits must not be negative")
    flag = F.coalesce(F.col(synthetic), F.lit(False))
    real = df.filter(~flag).orderBy(*order).limit(most_real)
    made = capped(df.filter(flag).withColumn("__all", F.lit(1)).orderBy(*order).limit(most_synthetic), ["__all"], order, most_synthetic).drop("__all")
    allowed = F.broadcast(real.agg((F.count("*") * 2).alias("__most")))  # one row
    return real.unionByName(made.join(allowed, F.col("rank") <= F.col("__most")).drop("rank", "__most"))


def versioning(previous: DataFrame, current: DataFrame, key: str, ignored: Sequence[str], referred: Sequence[str], reason: str) -> DataFrame:
    """(key, event): added, changed, changed_without_reason, replaced or disappeared.

    ``ignored`` columns and the key don't count as change; a row that is gone is
    ``replaced`` if some ``referred`` column of the current rows names it.
    """
    names = [c for c in current.columns if c not in {key, *ignored}]
    payload = F.sha2(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}), 256)
    old = previous.select(key, payload.alias("__old"))
    new = current.select(key, payload.alias("__new"), F.col(reason).alias("__why"))
    named = None
    for c in referred:
        part = current.filter(F.col(c).isNotNull()).select(F.col(c).alias(key))
        named = part if named is None else named.unionByName(part)
    marks = named.distinct().withColumn("__named", F.lit(True))
    both = old.join(new, key, "full_outer").join(marks, key, "left")
    event = (
        F.when(F.col("__old").isNull(), "added")
        .when(F.col("__new").isNull(), F.when(F.col("__named"), "replaced").otherwise("disappeared"))
        .when(F.col("__old") != F.col("__new"), F.when(F.length(F.trim("__why")) > 0, "changed").otherwise("changed_without_reason"))
    )
    return both.select(key, event.alias("event")).filter("event IS NOT NULL")


def ordered(df: DataFrame, split: str, order: Sequence[str]) -> DataFrame:
    """``df`` with ``place``, its place from 0 by split, then ``order``; ranks run inside a split and splits' counts are added up."""
    ranked = df.withColumns({"__s": split_rank(F.col(split)), "__at": F.row_number().over(Window.partitionBy(split_rank(F.col(split))).orderBy(*order)) - 1})
    counts = ranked.groupBy("__s").agg(F.count("*").alias("__n"))
    offsets = counts.select("__s", (F.sum("__n").over(Window.orderBy("__s")) - F.col("__n")).alias("__o"))  # one row a split
    return ranked.join(F.broadcast(offsets), "__s").withColumn("place", F.col("__at") + F.col("__o")).drop("__s", "__at", "__o")


def restrict(frames: dict[str, tuple[DataFrame, Sequence[str]]], ids: DataFrame, key: str) -> dict[str, DataFrame]:
    """The named frames cut down to rows all of whose id columns are among ``ids``; null ids are not."""
    known = ids.select(F.col(key).alias("__id")).distinct()
    out = {}
    for name, (df, columns) in frames.items():
        for c in columns:
            df = df.join(known, df[c] == known["__id"], "left_semi")
        out[name] = df
    return out


def has_zone(col: Column) -> Column:
    """Whether an ISO time says its zone."""
    return F.coalesce(col.rlike(r"T.*(Z|[+-]\d\d:?\d\d)$"), F.lit(False))


def expired(col: Column, today: Column) -> Column:
    """Whether a day lies before today; one that isn't given never does."""
    return F.coalesce(F.to_date(col) < F.to_date(today), F.lit(False))


def against_targets(counts: DataFrame, targets: DataFrame, key: str, count: str = "n", target: str = "target") -> DataFrame:
    """(key, count, target, gap, status): every target beside what there is; sources without rows count 0, those without target are left out."""
    n = F.coalesce(F.col(count), F.lit(0))
    joined = targets.select(key, target).join(counts.select(key, count), key, "left")
    gap = F.greatest(F.lit(0), F.col(target) - n)
    return joined.select(key, n.alias(count), F.col(target), gap.alias("gap"), F.when(n == 0, "missing").when(gap > 0, "short").otherwise("met").alias("status"))

"""Which rows of which sources take part."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_sources(df: DataFrame, source: str, include: Sequence[str], exclude: Sequence[str] = ()) -> DataFrame:
    """Rows of the included sources that are not excluded, with the place of their source in the list."""
    chosen = [s for s in include if s not in set(exclude)]
    place = F.array_position(F.array(*[F.lit(s) for s in chosen]), F.col(source)) if chosen else F.lit(0)
    return df.filter(F.col(source).isin(chosen)).withColumn("source_rank", place)


def cap_share(df: DataFrame, flag: str, group: Sequence[str], order: Sequence[Column], share: float) -> DataFrame:
    """Flagged rows up to ``share`` of what is kept of each group, in order; all others are kept.

    The number follows from the real count, which a one-pass aggregate gives;
    ranks are needed for flagged rows only.
    """
    if share >= 1:
        return df
    real = df.filter(~F.coalesce(F.col(flag), F.lit(False))).groupBy(*group).agg(F.floor(F.count("*") * share / (1 - share)).alias("__most"))
    w = Window.partitionBy(*group).orderBy(*order)
    flagged = df.filter(F.col(flag)).withColumn("__rank", F.row_number().over(w)).join(real, list(group), "left")
    kept = flagged.filter(F.col("__rank") <= F.coalesce("__most", F.lit(0))).drop("__rank", "__most")
    return df.filter(~F.coalesce(F.col(flag), F.lit(False))).unionByName(kept)


def keep_first(frames: Sequence[DataFrame], key: str, order: Sequence[str]) -> DataFrame:
    """Rows of all frames, one for each key: of the first frame that has it, by ``order`` within the frame."""
    marked = [f.withColumn("__frame", F.lit(i)) for i, f in enumerate(frames)]
    both = marked[0]
    for m in marked[1:]:
        both = both.unionByName(m)
    w = Window.partitionBy(key).orderBy("__frame", *order)
    return both.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n", "__frame")


def promote(target: DataFrame, catalogue: DataFrame, rows: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(target, catalogue) after ``rows`` move from the catalogue to the target; they replace older rows there."""
    keys = rows.select(key).distinct()
    return target.join(keys, key, "left_anti").unionByName(rows), catalogue.join(keys, key, "left_anti")


def quantised_signature(vector: Column, levels: int = 16) -> Column:
    """Hash of a vector whose values, taken from [-1, 1], are cut to so many levels; null for one level only."""
    level = F.transform(vector, lambda x: F.least(F.lit(levels - 1), F.greatest(F.lit(0), F.floor((x.cast("double") + 1) * (levels / 2)).cast("int"))))
    return F.when(F.size(F.array_distinct(level)) > 1, F.sha2(F.array_join(level, ","), 256))


def template_rows(spark, count: int, templates: Sequence[str]) -> DataFrame:
    """``count`` numbered rows that take the templates in turn."""
    names = F.array(*[F.lit(t) for t in templates])
    return spark.range(count).select(F.format_string("synthetic-%d", F.col("id") + 1).alias("source_item_id"), F.element_at(names, (F.col("id") % len(templates) + 1).cast("int")).alias("template_id"))

"""Groups that lie on both sides of a held-out set, and the accepted exceptions.

Members stay rows: a group is told by its counts and by a digest of each side's
members that does not depend on their order, so a group with a third of all rows
is no larger than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def members(df: DataFrame, item: str, kinds: Sequence[str]) -> DataFrame:
    """(kind, group_id, item) of all the kinds' columns, each once."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("group_id")) for k in kinds])).alias("g")
    return df.filter(F.col(item).isNotNull()).select(pairs, F.col(item).alias("item")).select("g.*", "item").filter("group_id IS NOT NULL").distinct()


def _digest(inside: Column) -> Column:
    """Of a set of items: 64 bits that add up, whatever the order."""
    return F.coalesce(F.bit_xor(F.when(inside, F.col("h"))), F.lit(0))


def risks(grouped: DataFrame, held_out: DataFrame, item: str = "item") -> DataFrame:
    """(kind, group_id, held_out, others, held_out_set, others_set) of the groups with members on both sides."""
    marks = held_out.select(F.col(item).alias("item")).distinct().withColumn("__held", F.lit(True))
    m = grouped.join(marks, "item", "left").withColumns({"held": F.coalesce("__held", F.lit(False)), "h": F.xxhash64("item")})
    per = m.groupBy("kind", "group_id").agg(
        F.count_if("held").alias("held_out"), F.count_if(~F.col("held")).alias("others"), _digest(F.col("held")).alias("held_out_set"), _digest(~F.col("held")).alias("others_set")
    )
    return per.filter("held_out > 0 AND others > 0")


def resolve(found: DataFrame, accepted: DataFrame) -> DataFrame:
    """(kind, group_id, held_out, others, status) of risks beside accepted ones of the same form.

    ``accepted`` if both sides have the same members as when it was accepted,
    ``stale`` if not, ``unresolved`` if it never was; what is accepted and no
    risk any more is ``unused``.
    """
    a = accepted.select("kind", "group_id", F.struct("held_out", "others", "held_out_set", "others_set").alias("__a"))
    f = found.select("kind", "group_id", "held_out", "others", F.struct("held_out", "others", "held_out_set", "others_set").alias("__f"))
    status = F.when(F.col("__f").isNull(), "unused").when(F.col("__a").isNull(), "unresolved").when(F.col("__a") == F.col("__f"), "accepted").otherwise("stale")
    return f.join(a, ["kind", "group_id"], "full_outer").select("kind", "group_id", F.coalesce("held_out", F.lit(0)).alias("held_out"), F.coalesce("others", F.lit(0)).alias("others"), status.alias("status"))

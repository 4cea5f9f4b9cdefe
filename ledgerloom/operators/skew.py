"""Joins that stay even when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: a key is hot if it holds more rows than HOT_ROWS and than the MAX_HOT_KEYS-th part of all
MAX_HOT_KEYS, HOT_ROWS = 5_000, 200_000


#: a frame is broadcast only if its rows, written as JSON, are counted and take no more than this
BROADCAST_BYTES = 16 << 20


def is_small(df: DataFrame, most: int = BROADCAST_BYTES) -> bool:
    """Whether a (stored) frame takes no more than ``most`` bytes; it is read once to know."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*df.columns)))), F.lit(0)).alias("n")).first()
    return size["n"] <= most


def lookup_stored(left: DataFrame, right: DataFrame, key: str, how: str = "inner", most: int = BROADCAST_BYTES) -> DataFrame:
    """Join of ``left`` with a stored ``right``, which holds each ``key`` once.

    A ``right`` of no more than ``most`` bytes is broadcast, so that ``left``
    stays where it lies; beyond that it is a :func:`lookup`.
    """
    return left.join(F.broadcast(right), key, how) if is_small(right, most) else lookup(left, right, key, how=how)


def hot_keys(df: DataFrame, key: str, n: int, max_keys: int = MAX_HOT_KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """The hot keys of a frame of ``n`` rows.

    By definition there are fewer than ``max_keys`` of them, however large the
    frame is. Counting reduces map-side, so a hot key moves one row a task.
    """
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n"))
    return counts.filter(F.col("__n") > max(hot_rows, n / max_keys)).select(key)


def lookup(left: DataFrame, right: DataFrame, key: str, n: int | None = None, how: str = "inner", max_keys: int = MAX_HOT_KEYS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join of ``left``, of ``n`` rows, with ``right``, which holds each ``key`` once; inner or left.

    Rows of hot keys meet a broadcast of those few keys' right rows and are not
    shuffled; all others are joined by a shuffle. A frame of no more than
    ``hot_rows`` rows cannot have a hot key and is joined at once.
    """
    n = left.count() if n is None else n
    if n <= hot_rows:
        return left.join(right, key, how)
    hot = F.broadcast(hot_keys(left, key, n, max_keys, hot_rows))
    hot_right = F.broadcast(right.join(hot, key, "left_semi"))
    hot_part = left.join(hot, key, "left_semi").join(hot_right, key, how)
    cold_part = left.join(hot, key, "left_anti").join(right, key, how)
    return hot_part.unionByName(cold_part)

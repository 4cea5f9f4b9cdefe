"""Change derivation between consecutive full snapshots.

Every key gets a persistent ordinal, ``(block << 32) | position``, kept in a
stored table that only grows: the block is a hash of the key over a fixed number
of blocks, and keys that the table lacks are appended behind the last position
of their block, in the order of (first snapshot, key). A later or late snapshot
moves no ordinal. Per snapshot the present ordinals form a compressed bitmap
(:mod:`ledgerloom.functions.bitmaps`); AND-NOT of two consecutive bitmaps gives
removals and additions, AND gives the common keys, and for each watched group
of columns an ordinal-aligned vector of value digests shows which changed.

Shuffles: one on (key, snapshot) after a map-side reduction to the latest row,
so a key repeated in a third of the rows is reduced before it moves; one on the
key to meet the ordinals, if there are any yet; one on the block; one on the
containers of 2^16 ordinals, of which a task holds as many as ``rows_per_block``
rows make, and one at least.

Defined cases: a null key or null snapshot name is an ordinary value equal only
to null; a snapshot that holds a key more than once counts the row with the
latest arrival (null arrivals first), ties by the larger digest; an empty table
gives no rows; a single snapshot gives no rows; columns that are not named in
``keys``/``ignored`` belong to the ``rest`` group whatever they are called;
values nested in arrays, structs and maps are compared as exactly as others.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import bitmaps
from ledgerloom.storage import materialize, run_dir

ROWS_PER_BLOCK = 40_000
#: blocks of a table of ordinals, fixed for its life
BLOCKS = 1024


def _counted(text: Column) -> Column:
    """A part of a longer text: its length before it, null with a mark of its own."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~"))


def _canonical(col: Column, dtype: T.DataType) -> Column:
    """Text of a value such that equal values, and only those, give equal text."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        # 0.0 and -0.0 compare equal; so do all NaN
        return F.when(col == 0, F.lit("0")).otherwise(col.cast("string"))
    if isinstance(dtype, T.StructType):
        parts = F.concat(F.lit("("), *[_counted(_canonical(col[f.name], f.dataType)) for f in dtype.fields])
        return F.when(col.isNotNull(), parts)
    if isinstance(dtype, T.ArrayType):
        return F.concat(F.lit("["), F.array_join(F.transform(col, lambda x: _counted(_canonical(x, dtype.elementType))), ""))
    if isinstance(dtype, T.MapType):
        pair = T.StructType([T.StructField("key", dtype.keyType), T.StructField("value", dtype.valueType)])
        texts = F.transform(F.map_entries(col), lambda x: _counted(_canonical(x, pair)))
        return F.concat(F.lit("{"), F.array_join(F.array_sort(texts), ""))
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    return col.cast("string")


def digest(df: DataFrame, names: Sequence[str]) -> Column:
    """16 bytes that stand for the exact values of the named columns.

    Each value is written with its length, null with a mark of its own, so two
    different rows never give the same text.
    """
    if not names:
        return F.lit(bytes(16))
    parts = []
    for name in names:
        parts.append(_counted(_canonical(F.col(f"`{name}`"), df.schema[name].dataType)))
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def snapshot_order(df: DataFrame, snapshot: str, taken_at: str) -> DataFrame:
    """One row per snapshot with its rank and its predecessor.

    The number of snapshots does not grow with the rows, so a window over all
    of them is one short task.
    """
    named = df.groupBy(F.col(f"`{snapshot}`").alias("snapshot")).agg(F.min(F.col(f"`{taken_at}`")).alias("taken_at"))
    w = Window.orderBy(F.col("taken_at").asc_nulls_first(), F.col("snapshot").asc_nulls_first())
    return named.select("snapshot", F.row_number().over(w).alias("rank"), F.lag("snapshot").over(w).alias("previous"))


def latest_rows(df: DataFrame, key: str, snapshot: str, arrived_at: str, groups: dict[str, Sequence[str]]) -> DataFrame:
    """The row that counts of each (key, snapshot), reduced to value digests."""
    digests = [digest(df, cols).alias(f"d_{g}") for g, cols in groups.items()]
    names = [f"d_{g}" for g in groups]
    slim = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{snapshot}`").alias("snapshot"), F.col(f"`{arrived_at}`").alias("arrived"), *digests)
    best = F.max(F.struct("arrived", *names)).alias("row")
    return slim.groupBy("key", "snapshot").agg(best).select("key", "snapshot", *[F.col(f"row.{n}").alias(n) for n in names])


def assign_ordinals(rows: DataFrame, blocks: int = BLOCKS, known: DataFrame | None = None) -> DataFrame:
    """Adds ``first``, ``block`` and ``position``: the key's first rank and its ordinal, behind those of ``known`` (key, block, position).

    ``rows`` has ``key``, none of them in ``known``, and ``rank`` (the
    snapshot's rank). Both windows run on the block's partitioning, so this
    takes a single exchange.
    """
    block = F.pmod(F.xxhash64(F.col("key")), F.lit(blocks)).cast("int")
    first = F.min("rank").over(Window.partitionBy("block", "key"))
    position = F.dense_rank().over(Window.partitionBy("block").orderBy("first", F.col("key").asc_nulls_first())) - 1
    placed = rows.withColumn("block", block).repartition("block").withColumn("first", first).withColumn("position", position.cast("long"))
    if known is None:
        return placed
    used = F.broadcast(known.groupBy("block").agg((F.max("position") + 1).alias("__used")))  # one row a block
    return placed.join(used, "block", "left").withColumn("position", F.col("position") + F.coalesce("__used", F.lit(0))).drop("__used")


def stored_ordinals(spark: SparkSession, path: str, key_type: str) -> DataFrame | None:
    """The table of ordinals (key, block, position) at ``path``, if there is one yet."""
    try:
        return spark.read.schema(f"key {key_type}, block int, position long").parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def place(rows: DataFrame, path: str, blocks: int = BLOCKS) -> DataFrame:
    """``rows`` (key, rank and others; a key and rank once) with ``block`` and ``position``; keys that the table at ``path`` lacks are appended to it.

    One writer at a time; a write that fails leaves the table as it was.
    """
    known = stored_ordinals(rows.sparkSession, path, rows.schema["key"].dataType.simpleString())
    if known is None:
        placed = assign_ordinals(rows, blocks)
    else:
        old = known.select(F.col("key").alias("__key"), "block", "position")
        joined = rows.join(old, rows["key"].eqNullSafe(old["__key"]), "left").drop("__key")
        fresh = assign_ordinals(joined.filter("block IS NULL").drop("block", "position"), blocks, known)
        placed = joined.filter("block IS NOT NULL").withColumn("first", F.lit(None).cast("int")).unionByName(fresh)
    placed = materialize(placed, "placed")
    # a new key's row of its first rank stands for it
    placed.filter(F.col("rank") == F.col("first")).select("key", "block", "position").write.mode("append").parquet(path)
    return placed.drop("first")


def _compare(groups: Sequence[str]):
    def one_task(pdf: pd.DataFrame) -> pd.DataFrame:
        ranks = np.sort(pdf["rank"].unique())
        # bitmaps and vectors are over the ordinals that the task holds, in their order: blocks leave gaps
        ordinals, place = np.unique(pdf["ordinal"].to_numpy(), return_inverse=True)
        keys = np.empty(len(ordinals), dtype=object)
        keys[place] = pdf["key"].to_numpy()
        present, vectors = {}, {}
        for r in ranks:
            mine = (pdf["rank"] == r).to_numpy()
            part, at = pdf[mine], place[mine]
            present[r] = bitmaps.compress(at)
            for g in groups:
                raw = np.frombuffer(b"".join(part[f"d_{g}"]), dtype=np.uint64).reshape(-1, 2)
                vec = np.zeros((len(ordinals), 2), dtype=np.uint64)
                vec[at] = raw
                vectors[r, g] = vec
        out: list[pd.DataFrame] = []

        def add(rank: int, found: np.ndarray, kind: str) -> None:
            if len(found):
                out.append(pd.DataFrame({"rank": rank, "key": keys[found], "change_type": kind}))

        empty = bitmaps.compress(np.empty(0, dtype=np.int64))
        for r in sorted({*ranks, *(ranks + 1)}):
            new, old = present.get(r, empty), present.get(r - 1, empty)
            add(r, bitmaps.and_not(new, old), "added")
            add(r, bitmaps.and_not(old, new), "removed")
            both = bitmaps.intersect(new, old)
            for g in groups if len(both) else ():
                a, b = vectors[r, g][both], vectors[r - 1, g][both]
                add(r, both[(a != b).any(axis=1)], g)
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"rank": [], "key": [], "change_type": []})

    return one_task


def snapshot_changes(
    df: DataFrame,
    key: str,
    snapshot: str,
    taken_at: str,
    arrived_at: str,
    groups: dict[str, Sequence[str]],
    rest: str = "metadata",
    rows_per_block: int = ROWS_PER_BLOCK,
    ordinals: str | None = None,
) -> DataFrame:
    """(previous, snapshot, key, change_type) for every two consecutive snapshots.

    ``groups`` names sets of watched columns; all columns that are neither in
    one of them nor the key, snapshot, ``taken_at`` or ``arrived_at`` form the
    group ``rest``. ``ordinals`` is the path of the table of ordinals, which
    outlives the run; without one the run keeps its own in the shared folder.
    """
    named = {c for cols in groups.values() for c in cols} | {key, snapshot, taken_at, arrived_at}
    all_groups = {**groups, rest: [c for c in df.columns if c not in named]}
    order = snapshot_order(df, snapshot, taken_at)
    spark = df.sparkSession
    path = ordinals or f"{run_dir(spark)}/ordinals-{uuid.uuid4().hex}"
    rows = latest_rows(df, key, snapshot, arrived_at, all_groups)
    ranks = F.broadcast(order.select(F.col("snapshot").alias("s"), "rank"))  # one row per snapshot
    placed = place(rows.join(ranks, F.col("snapshot").eqNullSafe(F.col("s"))).drop("s", "snapshot"), path)
    # the count reads only file footers; it sizes tasks, and no ordinal depends on it
    tasks = max(8, -(-placed.count() // rows_per_block))
    ordinal = F.shiftleft(F.col("block").cast("long"), 32).bitwiseOR(F.col("position"))
    known = placed.withColumn("ordinal", ordinal).drop("block", "position")
    task = F.pmod(F.xxhash64(F.shiftright("ordinal", 16)), F.lit(tasks))
    key_type = df.schema[key].dataType.simpleString()
    changes = known.withColumn("task", task).groupBy("task").applyInPandas(_compare(list(all_groups)), f"rank int, key {key_type}, change_type string")
    pairs = F.broadcast(order.filter("rank > 1").select("rank", F.col("previous").alias("previous_snapshot"), "snapshot"))
    return changes.join(pairs, "rank").select("previous_snapshot", "snapshot", "key", "change_type")

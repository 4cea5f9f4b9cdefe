"""The history operators kept up to date by streams."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.history import latest, upsert
from ledgerloom.storage import materialize


#: parts of an upserted table by hash of the keys; a batch rewrites the parts it touches
PARTS = 64
#: finished batches whose files stay, for readers that began before the newest one
KEPT_BATCHES = 2


class _Folder:
    """Small files of a table's folder, wherever Hadoop finds it."""

    def __init__(self, spark: SparkSession, path: str):
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.path, self.fs = path, self.hadoop.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.encode = spark.sparkContext._jvm.java.lang.String

    def at(self, name: str):
        return self.hadoop.Path(f"{self.path}/{name}")

    def names(self, name: str) -> list[str]:
        return sorted(f.getPath().getName() for f in self.fs.listStatus(self.at(name))) if self.fs.exists(self.at(name)) else []

    def read(self, name: str) -> dict[int, int]:
        """Part and the batch that wrote it, one a line."""
        stream = self.fs.open(self.at(name))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return {int(p): int(e) for p, e in (line.split() for line in text.splitlines())}

    def publish(self, name: str, where: dict[int, int]) -> None:
        """Written beside its place and moved into it."""
        draft = self.at(f"_draft-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, True)
        stream.write(bytearray("".join(f"{p} {e}\n" for p, e in sorted(where.items())).encode()))
        stream.close()
        self.fs.mkdirs(self.at(name).getParent())
        self.fs.rename(draft, self.at(name))


def upsert_sink(spark: SparkSession, path: str, keys: Sequence[str], version: str, parts: int = PARTS) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps a table of the last row per key.

    The table lies in ``parts`` by a hash of the keys, fixed for its life. A
    batch reads and rewrites the parts that it has keys of, and then names the
    files of all parts in one small file; so a batch that is repeated after a
    failure gives the same table, and readers see whole batches only. Files that
    no recent batch names are deleted.
    """
    folder = _Folder(spark, path)

    def write(batch: DataFrame, epoch: int) -> None:
        done = folder.names("_done")
        if done and int(done[-1]) >= epoch:
            return
        where = folder.read(f"_done/{done[-1]}") if done else {}
        order = [F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in batch.columns if c not in keys and c != version]]
        newest = materialize(latest(batch, keys, order).withColumn("__part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")), "batch")
        touched = [r["__part"] for r in newest.select("__part").distinct().collect()]  # no more than there are parts
        old = [f"{path}/b{where[p]}/__part={p}" for p in touched if p in where]
        if old:
            before = spark.read.option("recursiveFileLookup", "true").schema(batch.schema).parquet(*old).withColumn("__part", F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int"))
            newest = upsert(before, newest, [*keys, "__part"], version)
        newest.repartition("__part").write.mode("overwrite").partitionBy("__part").parquet(f"{path}/b{epoch}")
        folder.publish(f"_done/{epoch:012d}", where | {p: epoch for p in touched})
        _forget(folder)

    return write


def _forget(folder: _Folder, kept: int = KEPT_BATCHES) -> None:
    """Deletes the files that only older batches name."""
    done = folder.names("_done")
    named = {(p, e) for d in done[-kept:] for p, e in folder.read(f"_done/{d}").items()}
    for d in done[:-kept]:
        for p, e in folder.read(f"_done/{d}").items():
            if (p, e) not in named:
                folder.fs.delete(folder.at(f"b{e}/__part={p}"), True)
        folder.fs.delete(folder.at(f"_done/{d}"), False)


def read_upserted(spark: SparkSession, path: str) -> DataFrame:
    folder = _Folder(spark, path)
    done = folder.names("_done")
    if not done:
        raise FileNotFoundError(path)
    where = folder.read(f"_done/{done[-1]}")
    return spark.read.option("recursiveFileLookup", "true").parquet(*[f"{path}/b{e}/__part={p}" for p, e in where.items()])


def first_deliveries(stream: DataFrame, key: str, at: str, lateness: str) -> DataFrame:
    """Each key once, the first time it arrives; keys are forgotten ``lateness`` after their time."""
    return stream.withWatermark(at, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, at: str, by: Sequence[str], width: str, lateness: str) -> DataFrame:
    """Rows per window and group; a window is final once it is ``lateness`` old."""
    return stream.withWatermark(at, lateness).groupBy(F.window(at, width), *by).agg(F.count("*").alias("n"))

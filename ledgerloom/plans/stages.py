"""A chain of stages whose results are written, so that a run can go on where another one stopped."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class Stage:
    """``run`` takes the frames so far and returns the ones it adds or replaces."""

    name: str
    run: Callable[[SparkSession, Frames], Frames]


def _done(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_DONE")
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _names(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    listed = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return sorted(s.getPath().getName() for s in listed if s.isDirectory())


def execute(spark: SparkSession, stages: Sequence[Stage], folder: str, inputs: Frames, until: str | None = None, resume: bool = True) -> Frames:
    """All frames after the last stage.

    A stage counts as finished once all its frames are written; a finished one
    is read back on resuming, including frames of earlier stages it replaced.
    """
    names = [s.name for s in stages]
    if until is not None and until not in names:
        raise ValueError(f"no stage named {until!r}")
    frames = dict(inputs)
    fresh = not resume
    for i, stage in enumerate(stages):
        path = f"{folder}/{i:02d}_{stage.name}"
        if fresh or not _done(spark, path):
            fresh = True
            for name, df in stage.run(spark, dict(frames)).items():
                df.write.mode("overwrite").parquet(f"{path}/{name}")
            done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_DONE")
            done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(done, True).close()
        frames |= {name: spark.read.parquet(f"{path}/{name}") for name in _names(spark, path)}
        if stage.name == until:
            break
    return frames


def latest_run(spark: SparkSession, folder: str) -> str | None:
    """The run folder whose name comes last, if there is any."""
    names = _names(spark, folder)
    return f"{folder}/{names[-1]}" if names else None


def summary(spark: SparkSession, folder: str) -> DataFrame:
    """(stage, frame, rows, finished, warning) of a run: rows come from file footers; a frame without any and a stage that broke off are warned of."""
    rows = []
    for stage in _names(spark, folder):
        finished = _done(spark, f"{folder}/{stage}")
        for name in _names(spark, f"{folder}/{stage}"):
            n = spark.read.parquet(f"{folder}/{stage}/{name}").count() if finished else None
            rows.append((stage, name, n, finished, None if n else "no rows" if finished else "not finished"))
    return spark.createDataFrame(rows, "stage string, frame string, rows long, finished boolean, warning string")

"""Where intermediate tables live.

A cluster names a folder that all executors share in ``spark.checkpoint.dir``.
Tables written there outlive any executor, so they are used to cut lineage and
to read a computed result more than once.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session; a local session without one gets its own."""
    conf = spark.sparkContext.getConf()
    path = conf.get(CHECKPOINT_CONF) or spark.conf.get(CHECKPOINT_CONF, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set(CHECKPOINT_CONF, path)
    return path.rstrip("/")


def run_dir(spark: SparkSession) -> str:
    """The folder of this application's intermediate tables."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The returned frame has no lineage beyond the files, so a lost executor costs
    a re-read and a second use costs no recomputation.
    """
    path = f"{run_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_with(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """``materialize``, and aggregates of the rows that the write takes along, so that no second job counts them."""
    seen = Observation()
    stored = materialize(df.observe(seen, *[c.alias(n) for n, c in measures.items()]), label)
    return stored, seen.get


def clear(spark: SparkSession) -> None:
    """Deletes this application's intermediate tables; results must be written by then."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(run_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

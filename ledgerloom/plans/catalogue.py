"""All queries of the core library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.plans import curation_queries, dataset_queries, release_queries, selection_queries, snapshot_queries

_MODULES = (snapshot_queries, curation_queries, release_queries, selection_queries, dataset_queries)

QUERIES = {name: q for m in _MODULES for name, q in m.QUERIES.items()}
ORACLES = {name: sql for m in _MODULES for name, sql in m.ORACLES.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["p2_found"](spark, sf_dir)

"""Scoring of predicted against reference text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def score_pairs(examples: DataFrame, predictions: DataFrame, references: DataFrame, key: str = "item_id") -> DataFrame:
    """(key, status, distance, length, exact): examples without a prediction are skipped before references are looked for."""
    p = predictions.select(key, F.col("text").alias("p"))
    r = references.select(key, F.col("text").alias("r"))
    joined = examples.select(key).join(p, key, "left").join(r, key, "left")
    status = F.when(F.col("p").isNull(), "no_prediction").when(F.col("r").isNull(), "no_reference").otherwise("scored")
    ok = status == "scored"
    return joined.select(
        key,
        status.alias("status"),
        F.when(ok, F.levenshtein("p", "r")).alias("distance"),
        F.when(ok, F.length("r")).alias("length"),
        F.when(ok, F.col("p") == F.col("r")).alias("exact"),
    )


def corpus_metrics(scored: DataFrame) -> DataFrame:
    """One row: the micro-averaged character error rate, the exact rate and the coverage; null where nothing is scored."""
    n = F.count_if(F.col("status") == "scored")
    return scored.agg(
        F.count("*").alias("examples"),
        n.alias("scored"),
        F.count_if(F.col("status") == "no_reference").alias("missing_references"),
        F.bround(F.try_divide(F.sum("distance"), F.sum("length")), 6).alias("error_rate"),
        F.bround(F.try_divide(F.count_if("exact"), n), 6).alias("exact_rate"),
        F.bround(F.try_divide(n, F.count("*")), 6).alias("coverage"),
    )


def unexpected(records: DataFrame, examples: DataFrame, key: str = "item_id") -> DataFrame:
    """(key): records of no example."""
    return records.select(key).distinct().join(examples.select(key), key, "left_anti")


def report(examples: DataFrame, predictions: DataFrame, references: DataFrame, key: str = "item_id") -> DataFrame:
    """One row: the corpus metrics, what is beside the examples, and whether the result may be ranked.

    It may if there are examples, all of them are scored, there is a rate, and
    nothing is unexpected.
    """
    metrics = corpus_metrics(score_pairs(examples, predictions, references, key))
    extra = unexpected(predictions, examples, key).agg(F.count("*").alias("unexpected_predictions")).crossJoin(unexpected(references, examples, key).agg(F.count("*").alias("unexpected_references")))
    both = metrics.crossJoin(extra)  # one row each
    ready = (F.col("examples") > 0) & (F.col("scored") == F.col("examples")) & F.col("error_rate").isNotNull() & (F.col("unexpected_predictions") + F.col("unexpected_references") == 0)
    return both.withColumn("ready", ready)

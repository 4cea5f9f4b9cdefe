"""Rights statements to licences: aliases first, then the strategy of the source."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.text import fold, holds_any, strip
from ledgerloom.operators.joins import first_match


def normalise(df: DataFrame, text: str, source: str, licences: DataFrame, strategies: DataFrame, unknown: str = "UNKNOWN") -> DataFrame:
    """``df`` with ``license_id``, ``license_class`` and ``matched_by`` (alias, exact, contains, manual or unknown).

    ``licences``: (ord, id, aliases, class). ``strategies``: one row a source
    with (source, type, values, license_id, license_class), types exact_match,
    contains and manual_review. An id or alias decides whatever the source; the
    first entry by ``ord`` wins. Null and blank texts can only be left to manual
    review.
    """
    dim = licences.select("ord", F.struct(F.col("id"), F.col("class")).alias("__entry"), F.concat(F.array("id"), F.coalesce("aliases", F.array())).alias("__labels"))
    labels = F.filter(F.transform("__labels", fold), lambda x: x != "")
    by_alias = first_match(df.withColumn("__text", fold(F.col(text))), F.col("__text"), dim, labels, "ord", "__entry")
    rules = F.broadcast(strategies.select(F.col("source").alias(source), "type", F.transform("values", fold).alias("__values"), F.struct(F.col("license_id").alias("id"), F.col("license_class").alias("class")).alias("__own")))  # one row a source
    joined = by_alias.join(rules, source, "left")
    has_text = F.coalesce(F.col("__text") != "", F.lit(False))
    exact = has_text & (F.col("type") == "exact_match") & F.array_contains("__values", F.col("__text"))
    contains = has_text & (F.col("type") == "contains") & F.exists("__values", lambda v: F.col("__text").contains(v))
    how = F.when(has_text & F.col("__entry").isNotNull(), "alias").when(exact, "exact").when(contains, "contains").when(F.col("type") == "manual_review", "manual").otherwise("unknown")
    fallback = F.broadcast(licences.filter(F.col("id") == unknown).select(F.struct("id", "class").alias("__unknown")).limit(1))  # the one entry
    chosen = F.when(how == "alias", F.col("__entry")).when(how == "unknown", F.col("__unknown")).otherwise(F.col("__own"))
    out = joined.join(fallback, F.lit(True), "left").withColumns({"__chosen": chosen, "matched_by": how, "raw_text_stripped": F.coalesce(strip(F.col(text)), F.lit(""))})
    return out.select(*df.columns, "raw_text_stripped", F.col("__chosen.id").alias("license_id"), F.col("__chosen.class").alias("license_class"), "matched_by")


def statement_in(html: Column, phrases: Sequence[str]) -> Column:
    """The first of the known rights phrases that a page holds, as it is written there; null if none."""
    found = F.regexp_extract(html, "(?iu)(" + "|".join(re.escape(p) for p in phrases) + ")", 1)
    return F.nullif(found, F.lit(""))


def standard_form(text: Column, standard: str, markers: Sequence[str]) -> Column:
    """The standard statement for texts that hold one of the markers, whatever the case; others stripped; null for blank ones."""
    plain = F.nullif(strip(text), F.lit(""))
    return F.when(holds_any(plain, markers), F.lit(standard)).otherwise(plain)

"""Content, period, language and quality classes of items, with confidence and reasons.

All are columns over one row, so a classification is a projection: no shuffle,
no Python. Keyword lists are parameters.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import has_hebrew, has_latin

#: fixed values: words that tell written from printed matter, and beginnings of years that are modern
HANDWRITTEN = ("כתב יד", "מכתב", "פנקס", "note")
PRINTED = ('דו"ח', "אישור", "report", "office copy")
MODERN_YEARS = ("193", "194", "195", "196", "197", "198", "199", "200", "201", "202")
#: below this a class needs a look
CONFIDENT = 0.65


def combined_text(title: Column, description: Column, values: Column) -> Column:
    """Title, description and all metadata values in one text; nulls are empty."""
    return F.trim(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(description, F.lit("")), F.array_join(F.coalesce(values, F.array().cast("array<string>")), " ")))


def _any_of(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | text.contains(w)
    return F.coalesce(found, F.lit(False))


def _case(rules: Sequence[tuple[Column, tuple]], otherwise: tuple) -> Column:
    """A struct <value, confidence, reason> by the first rule that holds."""

    def row(value, confidence, reason=None) -> Column:
        return F.struct(F.lit(value).alias("value"), F.lit(confidence).cast("double").alias("confidence"), F.lit(reason).cast("string").alias("reason"))

    out = None
    for when, then in rules:
        out = F.when(F.coalesce(when, F.lit(False)), row(*then)) if out is None else out.when(F.coalesce(when, F.lit(False)), row(*then))
    return out.otherwise(row(*otherwise))


def content_class(text: Column, template: Column, allowed: Column) -> Column:
    """By template, by words of the text, else by what the source may hold (an array of content types)."""
    low = F.lower(text)
    by_hand = F.exists(allowed, lambda t: t.contains("handwritten") | t.contains("manuscript"))
    in_print = F.exists(allowed, lambda t: t.contains("printed"))
    rules = [
        (template == "handwritten_note", ("handwritten", 0.95)),
        (template == "printed_letter", ("printed", 0.95)),
        (_any_of(low, HANDWRITTEN), ("handwritten", 0.85)),
        (_any_of(low, PRINTED), ("printed", 0.8)),
        (by_hand & in_print, ("mixed", 0.5, "content_conflicting_source_priors")),
        (by_hand, ("handwritten", 0.7)),
        (in_print, ("printed", 0.7)),
    ]
    return _case(rules, ("mixed", 0.45, "content_unknown"))


def period_class(text: Column, period: Column, synthetic: Column, historical_source: Column, modern_source: Column) -> Column:
    rules = [
        (synthetic, ("modern", 0.95)),
        ((F.lower(period) == "historical") | historical_source, ("historical", 0.95)),
        (modern_source, ("modern", 0.8)),
        (_any_of(F.lower(text), MODERN_YEARS), ("modern", 0.7, "period_inferred_from_year")),
    ]
    return _case(rules, ("modern", 0.6, "period_source_prior_only"))


def language_class(text: Column, synthetic: Column) -> Column:
    hebrew, latin = has_hebrew(text), has_latin(text)
    rules = [
        (synthetic, ("mixed_language", 0.85)),
        (hebrew & latin, ("mixed_language", 0.9)),
        (hebrew, ("hebrew_only", 0.9)),
        (latin, ("mixed_language", 0.65, "language_non_hebrew_title")),
    ]
    return _case(rules, ("hebrew_only", 0.55, "language_unknown"))


def quality(assets: Column, synthetic: Column) -> Column:
    """A struct <score, tier> from the number of assets and their mean width and height (structs <width, height>)."""
    n = F.size(F.coalesce(assets, F.array()))

    def mean(field: str) -> Column:
        total = F.aggregate(assets, F.lit(0.0), lambda acc, a: acc + F.coalesce(a[field], F.lit(0)).cast("double"))
        return F.when(n > 0, total / n).otherwise(F.lit(0.0))

    def plus(when: Column, tenths: int) -> Column:
        return F.when(F.coalesce(when, F.lit(False)), F.lit(tenths)).otherwise(F.lit(0))

    # hundredths, so that the sum is exact
    points = F.lit(50) + plus(n >= 1, 10) + plus(mean("width") >= 800, 15) + plus(mean("height") >= 1000, 15) + plus(synthetic, 10)
    score = F.least(points, F.lit(100)) / F.lit(100.0)
    return F.struct(score.alias("score"), F.when(score >= 0.8, "high").when(score >= 0.6, "medium").otherwise("low").alias("tier"))


def low_confidence(**classes: Column) -> Column:
    """The sorted names of the classes whose confidence is below ``CONFIDENT``."""
    return F.array_sort(F.array_compact(F.array(*[F.when(c["confidence"] < CONFIDENT, F.lit(f"{n}_low_confidence")) for n, c in classes.items()])))

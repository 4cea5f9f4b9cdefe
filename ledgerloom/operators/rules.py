"""A table of pattern rules applied to rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    id: str
    severity: int
    patterns: tuple[str, ...]
    fields: tuple[str, ...]
    case_sensitive: bool = False


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` with ``matched`` (sorted rule ids) and ``severity`` (the highest, 0 for none).

    Rules become one projection: rows are scanned once, nothing is joined.
    """
    hits, severity = [], F.lit(0)
    for r in rules:
        flags = "(?u)" if r.case_sensitive else "(?iu)"
        hit = F.lit(False)
        for p in r.patterns:
            for f in r.fields:
                hit = hit | F.coalesce(F.col(f).rlike(flags + p), F.lit(False))
        hits.append(F.when(hit, F.lit(r.id)))
        severity = F.greatest(severity, F.when(hit, r.severity).otherwise(0))
    return df.withColumns({"matched": F.array_sort(F.array_compact(F.array(*hits))), "severity": severity})

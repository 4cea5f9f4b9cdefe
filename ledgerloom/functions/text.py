"""Column expressions on text; all of them stay inside generated code."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(col: Column) -> Column:
    """Without white space of any script at either end."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def fold(col: Column) -> Column:
    """For comparing text whatever its case and surrounding white space."""
    return F.lower(strip(col))


def first_non_empty(*cols: Column) -> Column:
    """The first value that is neither null nor blank, stripped."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in cols])


def has_hebrew(col: Column) -> Column:
    return F.coalesce(col.rlike("[\\u0590-\\u05FF]"), F.lit(False))


def has_latin(col: Column) -> Column:
    return F.coalesce(col.rlike("[A-Za-z]"), F.lit(False))


def coverage(col: Column) -> dict[str, Column]:
    """What kinds of characters a Hebrew text holds."""
    kinds = {
        "letters": "[\\u05D0-\\u05EA]",
        "final_letters": "[\\u05DA\\u05DD\\u05DF\\u05E3\\u05E5]",
        "niqqud": "[\\u0591-\\u05BD\\u05BF\\u05C1\\u05C2\\u05C4\\u05C5\\u05C7]",
        "numerals": "[0-9]",
        "punctuation": "\\p{P}",
        "latin": "[A-Za-z]",
    }
    return {name: F.coalesce(col.rlike(pattern), F.lit(False)) for name, pattern in kinds.items()}


def script_class(col: Column) -> Column:
    hebrew, latin = has_hebrew(col), has_latin(col)
    return F.when(hebrew & latin, "mixed").when(hebrew, "hebrew").when(latin, "latin").otherwise("other")


def first_line(col: Column) -> Column:
    return strip(F.split(col, "\r\n|\r|\n").getItem(0))


def stable_id(prefix: str, col: Column) -> Column:
    """A short id that depends on the value alone."""
    return F.concat(F.lit(f"{prefix}:"), F.substring(F.sha2(col, 256), 1, 16))


def stable_bucket(col: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash: exact in a double."""
    return F.conv(F.substring(F.sha2(col, 256), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def natural_key(col: Column) -> Column:
    """Sorts as text in which numbers count by value: v0.9 before v0.10. Numbers of more than 20 digits follow, by length."""
    parts = F.regexp_extract_all(F.lower(col), F.lit(r"(\d+|\D+)"), F.lit(1))

    def part(p: Column) -> Column:
        digits = F.ltrim(p, F.lit("0"))
        long = F.concat(F.lit(":"), F.lpad(F.length(digits).cast("string"), 9, "0"), digits)
        return F.when(~p.rlike(r"^\d"), p).when(F.length(digits) <= 20, F.lpad(digits, 20, "0")).otherwise(long)

    return F.array_join(F.transform(parts, part), "")


def escape_html(col: Column) -> Column:
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        col = F.replace(col, F.lit(raw), F.lit(entity))
    return col


def safe_name(col: Column) -> Column:
    """A name that any file system takes."""
    return F.regexp_replace(col, "[^A-Za-z0-9._-]", "_")


def url_host(col: Column) -> Column:
    return F.lower(F.try_parse_url(col, F.lit("HOST")))


def url_path(col: Column) -> Column:
    """The decoded path; a plus sign stays one."""
    return F.try_url_decode(F.replace(F.try_parse_url(col, F.lit("PATH")), F.lit("+"), F.lit("%2B")))


def url_extension(col: Column) -> Column:
    return F.lower(F.regexp_extract(col, r"\.([A-Za-z0-9]{1,5})(?:[?#].*)?$", 1))


def is_portable_path(col: Column) -> Column:
    """A relative path without parent steps, back slashes, drive letters or home marks."""
    bad = col.rlike(r"^\s*$|^[/~]|\\|^[A-Za-z]:|(^|/)\.\.?(/|$)|//|^\s|\s$|^[A-Za-z][A-Za-z0-9+.-]*://")
    return F.coalesce(~bad, F.lit(False))


def looks_local(col: Column) -> Column:
    """A path that means something on one machine only; addresses on the web and in packages are none, whatever they hold."""
    public = col.rlike(r"^(https?|package)://")
    local = col.rlike(r"^(/|file://|\\\\|[A-Za-z]:[\\/])|\.work[/\\]")
    return F.coalesce(~public & local, F.lit(False))


def casefold(col: Column) -> Column:
    """Full case folding but for rare scripts: "ß" and "ss" are one, as are the two small sigmas."""
    return F.replace(F.replace(F.lower(col), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def holds_any(col: Column, markers: Sequence[str]) -> Column:
    """Whether a text holds one of the markers, whatever the case."""
    found = F.lit(False)
    for m in markers:
        found = found | F.lower(col).contains(m.lower())
    return F.coalesce(found, F.lit(False))


@F.pandas_udf(T.BooleanType())
def is_nfc(text: pd.Series) -> pd.Series:
    """Whether a text is in normal form C; null for null."""
    return text.map(lambda t: None if t is None else unicodedata.is_normalized("NFC", t)).astype("boolean")

"""Column expressions on paths and addresses."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.text import looks_local

#: fixed values: stored extensions and the media types that stand for them
EXTENSIONS = {"image/jpeg": "jpg", "image/png": "png", "image/tiff": "tif", "image/svg+xml": "svg", "image/webp": "webp", "application/pdf": "pdf"}


def is_portable(col: Column, *, trimmed: bool = True, no_work: bool = True, drive: str = "letter", home: bool = True) -> Column:
    """A relative path that means the same on every machine.

    Never portable: empty ones and those of own steps only, absolute ones, parent
    steps, back slashes, schemes. The flags part the variants that intakes use: outer white
    space allowed or not (``trimmed``), a ``.work`` folder (``no_work``), a
    colon in second place after a letter or after anything (``drive``), a
    leading home mark allowed or not (``home``).
    """
    bad = (F.length(col) == 0) | col.rlike(r"^/|\\|://|(^|/)\.\.(/|$)|^\.(/+\.)*/*$")
    bad = bad | col.rlike("^[A-Za-z]:" if drive == "letter" else "^.:")
    if trimmed:
        bad = bad | col.rlike(r"(?U)^\s|\s$")
    if no_work:
        bad = bad | col.rlike(r"(^|/)\.work(/|$)")
    if not home:
        bad = bad | col.startswith("~")
    return F.coalesce(~bad, F.lit(False))


#: the variants: of manifests and of evaluation, of batch assets and of their check, of the handwriting intake
VARIANTS = {
    "manifest": {},
    "batch": {"trimmed": False, "no_work": False, "drive": "any"},
    "intake": {"no_work": False, "home": False},
}


def without_local(col: Column, dtype: T.DataType) -> Column:
    """A nested value without the strings that look like paths of one machine: left out of arrays, null in structs and maps."""
    if isinstance(dtype, T.StringType):
        return F.when(~looks_local(col), col)
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(col, lambda x: ~looks_local(x) | x.isNull()) if isinstance(dtype.elementType, T.StringType) else col
        return kept if isinstance(dtype.elementType, T.StringType) else F.transform(kept, lambda x: without_local(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[without_local(col[f.name], f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, T.MapType) and isinstance(dtype.valueType, T.StringType):
        return F.map_filter(col, lambda k, v: ~looks_local(v) | v.isNull())
    return col


def extension(url: Column, media_type: Column) -> Column:
    """The stored extension: of the address's path if it is a known one, else of the media type; null if neither tells."""
    known = [*EXTENSIONS.values(), "jpeg", "tiff"]
    own = F.lower(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"\.([A-Za-z0-9]+)$", 1))
    kind = F.lower(F.trim(F.regexp_replace(media_type, ";.*$", "")))
    by_type = F.create_map(*[F.lit(x) for pair in EXTENSIONS.items() for x in pair])[kind]
    return F.coalesce(F.when(own.isin(known), own), by_type)


def full_image(url: Column, marker: str, thumbnail: str, full: str) -> Column:
    """The address of the full image for that of a thumbnail, in addresses that hold ``marker``."""
    return F.when(url.contains(marker), F.replace(url, F.lit(thumbnail), F.lit(full))).otherwise(url)


def same_page(current: Column, seed: Column) -> Column:
    """Whether an address is the seed's, apart from a slash at the end and a query."""
    a, b = F.rtrim(current, F.lit("/")), F.rtrim(seed, F.lit("/"))
    return F.coalesce((F.length(a) > 0) & ((a == b) | F.startswith(a, F.concat(b, F.lit("?")))), F.lit(False))


def resolve(reference: str, root: str | None = None, package: str | None = None) -> Path:
    """The file that a configuration names: in the package, absolute, or relative to the configuration."""
    if reference.startswith("package://"):
        if package is None:
            raise ValueError(f"no package folder to resolve {reference} in")
        return (Path(package) / reference.removeprefix("package://")).resolve()
    if Path(reference).is_absolute():
        return Path(reference)
    if root is None:
        raise ValueError(f"no folder to resolve {reference} in")
    return (Path(root) / reference).resolve()

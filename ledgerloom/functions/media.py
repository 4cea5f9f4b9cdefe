"""Format, size and integrity of image files, from their bytes."""

from __future__ import annotations

import re
import struct

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: fixed values: the first bytes of file formats
SIGNATURES = ((b"\x89PNG\r\n\x1a\n", "png"), (b"\xff\xd8\xff", "jpeg"), (b"GIF8", "gif"), (b"II*\x00", "tiff"), (b"MM\x00*", "tiff"), (b"%PDF", "pdf"))


def file_format(data: bytes) -> str | None:
    for head, name in SIGNATURES:
        if data.startswith(head):
            return name
    if data[:4] == b"RIFF" and data[8:12] == b"WEBP":
        return "webp"
    head = data[:1024].lstrip(b"\xef\xbb\xbf \t\r\n").lower()
    return "svg" if head.startswith(b"<svg") or head.startswith((b"<?xml", b"<!doctype svg")) and b"<svg" in head else None


def _png(data: bytes) -> tuple[int, int] | None:
    return struct.unpack(">II", data[16:24]) if len(data) >= 24 and data[12:16] == b"IHDR" else None


def _jpeg(data: bytes) -> tuple[int, int] | None:
    """Dimensions from the start-of-frame segment; other segments are stepped over by their length."""
    at = 2
    while at + 9 <= len(data):
        if data[at] != 0xFF:
            return None
        kind = data[at + 1]
        if kind == 0xFF:
            at += 1
        elif kind == 0x01 or 0xD0 <= kind <= 0xD8:
            at += 2
        elif 0xC0 <= kind <= 0xCF and kind not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", data[at + 5 : at + 9])
            return width, height
        else:
            at += 2 + struct.unpack(">H", data[at + 2 : at + 4])[0]
    return None


_SVG = re.compile(rb"<svg\b[^>]*>", re.IGNORECASE)
_LENGTH = rb"\s%s\s*=\s*[\"']\s*([0-9.]+)\s*(?:px)?\s*[\"']"


def _svg(data: bytes) -> tuple[int, int] | None:
    """Width and height, else those of the view box; halves round to even."""
    tag = _SVG.search(data)
    if not tag:
        return None
    w, h = (re.search(_LENGTH % n, tag[0], re.IGNORECASE) for n in (b"width", b"height"))
    if w and h:
        return round(float(w[1])), round(float(h[1]))
    box = re.search(rb"viewBox\s*=\s*[\"']\s*[-0-9.]+[\s,]+[-0-9.]+[\s,]+([0-9.]+)[\s,]+([0-9.]+)", tag[0], re.IGNORECASE)
    return (round(float(box[1])), round(float(box[2]))) if box else None


def describe(data: bytes | None) -> tuple[str | None, int | None, int | None, str | None]:
    """(format, width, height, problem)."""
    if not data:
        return None, None, None, "empty"
    kind = file_format(data)
    size = {"png": _png, "jpeg": _jpeg, "svg": _svg}.get(kind, lambda _: None)(data)
    if kind is None:
        return None, None, None, "unknown_format"
    return kind, *(size or (None, None)), None if size else "no_dimensions"


#: built from types, so that the module loads before there is a session
_DESCRIPTION = T.StructType([T.StructField("format", T.StringType()), T.StructField("width", T.LongType()), T.StructField("height", T.LongType()), T.StructField("problem", T.StringType())])


@F.pandas_udf(_DESCRIPTION)
def describe_image(content: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([describe(bytes(c) if c is not None else None) for c in content], columns=["format", "width", "height", "problem"]).astype({"width": "Int64", "height": "Int64"})

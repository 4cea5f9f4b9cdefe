"""A hash of how an image looks: grey, 16 by 16 points, 16 levels."""

from __future__ import annotations

import functools
import hashlib
import io
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

SIDE, LEVELS = 16, 16
#: fixed values: samples a pixel by PNG colour type
_CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}


def _unfilter(raw: bytes, height: int, stride: int, step: int) -> np.ndarray:
    """The lines of a PNG; each is a difference to what is left of it, above it or both."""
    data = np.frombuffer(raw, dtype=np.uint8)[: height * (stride + 1)].reshape(height, stride + 1)
    lines = np.zeros((height, stride), dtype=np.uint8)
    above = np.zeros(stride, dtype=np.uint8)
    for y in range(height):
        kind, line = data[y, 0], data[y, 1:].astype(np.int32)
        if kind == 0:
            out = line
        elif kind == 2:
            out = line + above
        elif kind == 1:
            out = np.concatenate([np.cumsum(line[c::step]) for c in range(step)]).reshape(step, -1).T.ravel() if stride % step == 0 else line
        elif kind in (3, 4):
            out = np.zeros(stride, dtype=np.int32)
            up = above.astype(np.int32)
            for x in range(stride):
                left = int(out[x - step]) & 255 if x >= step else 0
                if kind == 3:
                    guess = (left + int(up[x])) // 2
                else:
                    corner = int(up[x - step]) if x >= step else 0
                    p = left + int(up[x]) - corner
                    guess = min((left, int(up[x]), corner), key=lambda v: abs(p - v))
                out[x] = (line[x] + guess) & 255
        else:
            raise ValueError("unknown filter")
        above = lines[y] = (out & 255).astype(np.uint8)
    return lines


def _png(data: bytes) -> np.ndarray | None:
    """Grey values of a PNG of 8 bits a sample without interlacing; null for others."""
    at, head, palette, body = 8, None, None, []
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif kind == b"PLTE":
            palette = np.frombuffer(part, dtype=np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(part)
        at += size + 12
    if head is None or head[2] != 8 or head[6] or head[3] not in _CHANNELS:
        return None
    width, height, step = head[0], head[1], _CHANNELS[head[3]]
    lines = _unfilter(zlib.decompress(b"".join(body)), height, width * step, step).reshape(height, width, step)
    if head[3] == 3:
        lines = palette[lines[:, :, 0]]
    return _grey(lines)


def _grey(pixels: np.ndarray) -> np.ndarray:
    """Luma of colours; an alpha channel doesn't count."""
    if pixels.shape[2] < 3:
        return pixels[:, :, 0]
    r, g, b = (pixels[:, :, c].astype(np.int64) for c in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def decode(data: bytes) -> np.ndarray | None:
    """Grey values of an image; PNG by itself, other formats where an imaging library is installed; null if unreadable."""
    try:
        if data[:8] == b"\x89PNG\r\n\x1a\n" and (grey := _png(data)) is not None:
            return grey
        from PIL import Image

        return np.asarray(Image.open(io.BytesIO(data)).convert("L"))
    except (ImportError, OSError, ValueError, IndexError, zlib.error, struct.error):
        return None


@functools.lru_cache(maxsize=256)
def _weights(size: int) -> np.ndarray:
    """Lanczos weights, three lobes wide, from ``size`` points to ``SIDE``; wider when points are taken together."""
    scale = max(size / SIDE, 1.0)
    centre = (np.arange(SIDE) + 0.5) * size / SIDE
    x = (np.arange(size)[None, :] + 0.5 - centre[:, None]) / scale
    w = np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)
    return w / w.sum(axis=1, keepdims=True)


def look(data: bytes | None) -> str | None:
    """The hash; null for what can't be read and for images of one level."""
    grey = decode(data) if data else None
    if grey is None or not grey.size:
        return None
    across = np.clip(np.floor(grey.astype(np.float64) @ _weights(grey.shape[1]).T + 0.5), 0, 255)
    small = np.clip(np.floor(_weights(grey.shape[0]) @ across + 0.5), 0, 255)
    levels = np.clip(np.rint(small / (255 / (LEVELS - 1))), 0, LEVELS - 1).astype(np.uint8)
    return None if len(np.unique(levels)) < 2 else hashlib.sha256(levels.tobytes()).hexdigest()


def _looks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"path": pdf["path"], "look": [look(c) for c in pdf["content"]]})


def looks(files: DataFrame) -> DataFrame:
    """(path, look) of binary files (path, content); images are read where they lie, a few at a time."""
    return files.select("path", "content").mapInPandas(_looks, "path string, look string")

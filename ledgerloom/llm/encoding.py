"""Encoding of a whole text column by a public byte-level BPE vocabulary.

Texts of at most ``piece_chars`` are encoded in Arrow batches where they lie,
without a shuffle. A longer text is cut and its pieces are encoded by different
tasks:

* between a letter or digit and an ASCII white-space character the vocabulary's
  pattern always splits, whatever surrounds them, so pieces cut there are
  simply put one after the other;
* a stretch without such a place is cut into halves, quarters and so on, and put
  together again as a tree: at each join a window of tokens around it is
  encoded anew, and grows until its first tokens are the left side's and its
  last tokens are the right side's. Then both sides agree and the whole is the
  encoding of the unsplit text.

Equal long texts are encoded once. The vocabulary is a file on every worker;
its path is a parameter.

Defined cases: null and empty text give an empty list; repeated rows stay
repeated; an empty table gives no rows; strings of special tokens are ordinary
text; a null id is kept; columns other than the two named are not read.
"""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECE_CHARS = 16_384
FIRST_WINDOW = 8
#: fixed values: the split pattern that belongs to the vocabulary's rank file
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=4)
def load(path: str, pattern: str = PATTERN):
    """The encoder of a rank file; kept for the life of a Python worker."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _ids(encoder, text: str) -> np.ndarray:
    return encoder.encode_to_numpy(text, allowed_special=set(), disallowed_special=()).astype(np.int32) if text else np.empty(0, dtype=np.int32)


_SAFE = re.compile(r"(?<=[^\W_])(?=[ \n\t\r])")


def cut(text: str, size: int) -> list[tuple[str, bool]]:
    """Pieces of at most ``size`` characters, each with whether the cut before it is a sure one."""
    pieces, start, sure = [], 0, True
    while len(text) - start > size:
        places = [m.start() for m in _SAFE.finditer(text, start + size // 2, start + size)]
        places = [p for p in places if p > start]
        at = places[-1] if places else start + size
        pieces.append((text[start:at], sure))
        start, sure = at, bool(places)
    pieces.append((text[start:], sure))
    return pieces


def _decodable(encoder, tokens: np.ndarray) -> str | None:
    try:
        return encoder.decode_bytes(tokens.tolist()).decode("utf-8")
    except UnicodeDecodeError:
        return None


def join_at(encoder, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The encoding of the two sides' texts together.

    Agreement asks for two equal tokens at each end of the window, or for the
    whole of a side to lie in it.
    """
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    width = FIRST_WINDOW
    while True:
        a, b = max(0, len(left) - width), min(len(right), width)
        while a > 0 and _decodable(encoder, left[a:]) is None:
            a -= 1
        while b < len(right) and _decodable(encoder, right[:b]) is None:
            b += 1
        text = _decodable(encoder, np.concatenate([left[a:], right[:b]]))
        window = _ids(encoder, text)
        head, tail = min(2, len(left) - a), min(2, b)
        left_agrees = a == 0 or (len(window) >= head and np.array_equal(window[:head], left[a : a + head]))
        right_agrees = b == len(right) or (len(window) >= tail and np.array_equal(window[len(window) - tail :], right[b - tail : b]))
        if left_agrees and right_agrees and len(window) >= (head if a else 0) + (tail if b < len(right) else 0):
            return np.concatenate([left[:a], window, right[b:]])
        width *= 2


def concatenate(encoder, parts: list[np.ndarray], sure: list[bool]) -> np.ndarray:
    """Joins the pieces of one text as a balanced tree; ``sure[i]`` is about the cut before piece i."""
    while len(parts) > 1:
        merged, flags = [], []
        for i in range(0, len(parts) - 1, 2):
            both = np.concatenate(parts[i : i + 2]) if sure[i + 1] else join_at(encoder, parts[i], parts[i + 1])
            merged.append(both)
            flags.append(sure[i])
        if len(parts) % 2:
            merged.append(parts[-1])
            flags.append(sure[-1])
        parts, sure = merged, flags
    return parts[0]


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, dtype=np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=pa.int32()))


def _encode_column(path: str, pattern: str, text: str):
    """Replaces the column ``text`` by ``ids`` in each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(text)
            ids = _lists([_ids(encoder, t) for t in batch.column(at).to_pylist()])
            keep = [i for i in range(batch.num_columns) if i != at]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [ids], [batch.schema.field(i).name for i in keep] + ["ids"])

    return run


def _cut_batches(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pieces = cut(text, size)
                yield pa.RecordBatch.from_pydict(
                    {"key": [key] * len(pieces), "pos": pa.array(range(len(pieces)), pa.int32()), "sure": [s for _, s in pieces], "piece": [p for p, _ in pieces]}
                )

    return run


def _assemble(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load(path, pattern)
        for batch in batches:
            whole = []
            for parts in batch.column(1).to_pylist():
                parts.sort(key=lambda p: p["pos"])
                whole.append(concatenate(encoder, [np.array(p["ids"], dtype=np.int32) for p in parts], [p["sure"] for p in parts]))
            yield pa.RecordBatch.from_arrays([batch.column(0), _lists(whole)], ["key", "ids"])

    return run


def encode(df: DataFrame, id_col: str, text_col: str, vocabulary: str, pattern: str = PATTERN, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """(id, ids) for every row of ``df``.

    A row's own text and id list bound what a task holds of one text.
    """
    id_type = df.schema[id_col].dataType.simpleString()
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    is_long = F.coalesce(F.length("text") > piece_chars, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(_encode_column(vocabulary, pattern, "text"), f"id {id_type}, ids array<int>")

    long_rows = rows.filter(is_long).withColumn("key", F.sha2("text", 256))
    texts = long_rows.groupBy("key").agg(F.first("text").alias("text"))
    pieces = texts.mapInArrow(_cut_batches(piece_chars), "key string, pos int, sure boolean, piece string").repartition("key", "pos")
    coded = pieces.mapInArrow(_encode_column(vocabulary, pattern, "piece"), "key string, pos int, sure boolean, ids array<int>")
    whole = coded.groupBy("key").agg(F.collect_list(F.struct("pos", "sure", "ids")).alias("parts")).mapInArrow(_assemble(vocabulary, pattern), "key string, ids array<int>")
    long_coded = long_rows.select("id", "key").join(whole, "key").select("id", "ids")
    return short.unionByName(long_coded).withColumnRenamed("id", id_col)

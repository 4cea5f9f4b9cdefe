"""Held-out passages that leak into a corpus.

Texts become words: runs of letters and digits after full case folding, without
markup tags, character references and Hebrew points. Word n-grams of the
passages are looked for in all documents by a bitmap sized by their number, up to
a bound, so only documents that may hold one go on, with their words as 64-bit
hashes. Over all
documents each passage n-gram is counted, and of every stretch of ``min_words``
words of a passage the rarest n-gram becomes a seed: a document that holds the
stretch holds its seed. Seeds join documents to passages, and each pair is
aligned by Smith-Waterman around its seeds, many pairs at a time. The alignment
gives a score, by which :func:`edited` rates edited and paraphrased copies, and
the longest stretch of equal words, by which :func:`leaked` tells verbatim ones.

Seeds and passages are broadcast where a check of their bytes allows it, so a
seed or passage that a third of all documents hold is no larger a task than
others; shuffles then move n-gram counts and the word hashes of documents with a
seed. A passage n-gram that stands in a third of all documents is counted
map-side and is a seed only where its stretch has nothing rarer.

Defined cases: null and empty texts hold nothing; passages of fewer words than
``SEED`` give no seeds; a passage shorter than ``min_words`` is aligned but
cannot be a case; a repeated document or passage id stands for the same text
and gives one row; empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import is_small
from ledgerloom.storage import materialize

SEED = 5
MATCH, MISMATCH, GAP = 2, -1, -1
#: words around a seed's reach that are aligned too
MARGIN = 8
#: bits of the bitmap for each passage n-gram, and its least and largest size
BITS_A_GRAM, LEAST_BITS, MOST_BITS = 1024, 1 << 20, 1 << 27
#: a query of edited copies takes as seed the rarest n-gram of so many words, and reports this score, that of 12 words with every sixth replaced
EDITED_WORDS, EDITED_SCORE = 7, 18
#: cells that are aligned at once
CELLS = 1 << 20

_TAG = re.compile(r"</?[A-Za-z][^<>]*>|<!--.*?-->", re.DOTALL)
_REFERENCE = re.compile(r"&(?:#\d+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);")
#: points and accents of Hebrew, without its four punctuation marks
_POINTS = re.compile("[\u0591-\u05bd\u05bf\u05c1\u05c2\u05c4\u05c5\u05c7]")
_WORD = re.compile(r"[^\W_]+")
_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def words(text: str) -> list[str]:
    if "<" in text:
        text = _TAG.sub(" ", text)
    if "&" in text:
        text = _REFERENCE.sub(" ", text)
    return _WORD.findall(_POINTS.sub("", text).casefold())


class _Hashes(dict):
    """64-bit word hashes, kept for the words of a batch."""

    def __init__(self):
        import xxhash

        self.digest = xxhash.xxh3_64_intdigest

    def __missing__(self, word: str) -> int:
        h = self[word] = self.digest(word)
        return h


def _grams(hashes: np.ndarray, n: int = SEED) -> np.ndarray:
    """One hash for each run of ``n`` words."""
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    m = len(hashes) - n + 1
    out = hashes[:m].copy()
    for k in range(1, n):
        out = (out ^ out >> np.uint64(31)) * _P1 + hashes[k : k + m] * _P2
    return out ^ out >> np.uint64(29)


def _hashed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(ids, word hashes of all texts, ends of the texts)."""
    for batch in batches:
        table = _Hashes()
        ids, hashes, ends = [], [], []
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            hashes += [table[w] for w in words(text)] if text else []
            ids.append(i)
            ends.append(len(hashes))
        yield ids, np.array(hashes, dtype=np.uint64), np.array(ends, dtype=np.int64)


def _hash_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for ids, hashes, ends in _hashed_batches(batches):
        parts = np.split(hashes, ends[:-1])
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([p.view(np.int64) for p in parts], pa.list_(pa.int64()))], ["eval_id", "words"])


def _item_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, at, grams = [], [], []
        for i, w in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            g = _grams(np.array(w, dtype=np.int64).view(np.uint64)).view(np.int64)
            ids += [i] * len(g)
            at += range(len(g))
            grams += g.tolist()
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(at, pa.int32()), pa.array(grams, pa.int64())], ["eval_id", "at", "gram"])


def _slot(grams: np.ndarray, bits: int) -> np.ndarray:
    """Place of a gram in a bitmap of ``bits``, a power of two."""
    return (grams * _P2 >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def bitmap_bits(grams: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_GRAM * grams).bit_length()))


def _bitmap_batches(size: int):
    """A task's grams as one bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(size, dtype=bool)
        for batch in batches:
            bits[_slot(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), size)] = True
        if bits.any():
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], ["bits"])

    return run


def _hits(bc):
    """Documents with a gram in the bitmap: their words and those grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(bc.value, dtype=np.uint8)).astype(bool)
        for ids, hashes, ends in _hashed_batches(batches):
            grams = _grams(hashes)
            hit = np.flatnonzero(bits[_slot(grams, len(bits))])
            # a gram lies in the text of its first word, and must end there too
            text = np.searchsorted(ends, hit, side="right")
            inside = hit + SEED <= ends[np.minimum(text, len(ends) - 1)]
            hit, text = hit[inside], text[inside]
            out = {"doc_id": [], "words": [], "at": [], "grams": []}
            starts = np.concatenate(([0], ends[:-1]))
            for t in np.unique(text):
                own = hit[text == t]
                out["doc_id"].append(ids[t])
                out["words"].append(hashes[starts[t] : ends[t]].view(np.int64))
                out["at"].append((own - starts[t]).astype(np.int32))
                out["grams"].append(grams[own].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out["doc_id"], pa.int64()), pa.array(out["words"], pa.list_(pa.int64())), pa.array(out["at"], pa.list_(pa.int32())), pa.array(out["grams"], pa.list_(pa.int64()))],
                ["doc_id", "words", "at", "grams"],
            )

    return run


def choose_seeds(grams: DataFrame, counts: DataFrame, min_words: int) -> DataFrame:
    """(eval_id, at, gram): the rarest gram of every stretch of ``min_words`` words, the first of equally rare ones."""
    known = grams.join(counts, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    reach = min_words - SEED
    place = Window.partitionBy("eval_id").orderBy("at")
    rarest = F.min(F.struct("n", "at", "gram")).over(place.rangeBetween(0, reach)).alias("s")
    length = F.max("at").over(Window.partitionBy("eval_id"))
    stretches = known.select("eval_id", "at", rarest, length.alias("last")).filter((F.col("at") + reach <= F.col("last")) | (F.col("at") == 0))
    return stretches.filter("s.n > 0").select("eval_id", F.col("s.at").alias("at"), F.col("s.gram").alias("gram")).distinct()


def smith_waterman(docs: list[np.ndarray], items: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(score, longest equal stretch) of each pair, all pairs at once."""
    p = len(docs)
    rows, cols = max(map(len, docs), default=0), max(map(len, items), default=0)
    d = np.zeros((rows, p), dtype=np.uint64)
    e = np.ones((p, cols), dtype=np.uint64)
    in_d, in_e = np.zeros((rows, p), dtype=bool), np.zeros((p, cols), dtype=bool)
    for k, (x, y) in enumerate(zip(docs, items)):
        d[: len(x), k], in_d[: len(x), k] = x, True
        e[k, : len(y)], in_e[k, : len(y)] = y, True
    h = np.zeros((p, cols + 1), dtype=np.int32)
    run = np.zeros((p, cols + 1), dtype=np.int32)
    score, longest = np.zeros(p, np.int32), np.zeros(p, np.int32)
    slope = -GAP * np.arange(cols + 1, dtype=np.int32)
    for r in range(rows):
        same = (e == d[r][:, None]) & in_e & in_d[r][:, None]
        new = np.zeros_like(h)
        new[:, 1:] = np.maximum(0, np.maximum(h[:, :-1] + np.where(same, MATCH, MISMATCH), h[:, 1:] + GAP))
        # a gap in the document's side runs along the row: the best start to the left, less the way
        new = np.maximum(new, np.maximum.accumulate(new + slope, axis=1) - slope)
        h = new
        stretch = np.zeros_like(run)
        stretch[:, 1:] = np.where(same, run[:, :-1] + 1, 0)
        run = stretch
        score, longest = np.maximum(score, h.max(axis=1)), np.maximum(longest, run.max(axis=1))
    return score, longest


def _windows(doc: np.ndarray, item: np.ndarray, at: np.ndarray, of: np.ndarray) -> Iterator[np.ndarray]:
    """The stretches of a document around its seeds, merged where they meet.

    A local alignment of positive score spans less than three times the item,
    so long stretches are cut into pieces that overlap by that much.
    """
    low, high = np.maximum(0, at - of - MARGIN), np.minimum(len(doc), at - of + len(item) + MARGIN)
    order = np.argsort(low)
    low, high = low[order], np.maximum.accumulate(high[order])
    begins = np.flatnonzero(np.concatenate(([True], low[1:] > high[:-1])))
    overlap = 3 * len(item) + 2 * MARGIN
    for start, stop in zip(low[begins], high[np.append(begins[1:] - 1, len(high) - 1)]):
        while stop - start > 4 * overlap:
            yield doc[start : start + 2 * overlap]
            start += overlap
        yield doc[start:stop]


def _align(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        windows, items, owner = [], [], []
        for k, (doc, item, at, of) in enumerate(zip(pdf["doc_words"], pdf["item_words"], pdf["doc_at"], pdf["item_at"])):
            item = np.asarray(item, dtype=np.int64).view(np.uint64)
            for w in _windows(np.asarray(doc, dtype=np.int64).view(np.uint64), item, np.asarray(at, dtype=np.int64), np.asarray(of, dtype=np.int64)):
                windows.append(w)
                items.append(item)
                owner.append(k)
        score, longest = np.zeros(len(pdf), np.int32), np.zeros(len(pdf), np.int32)
        by_size = sorted(range(len(windows)), key=lambda i: (len(windows[i]), len(items[i])))
        while by_size:
            # the last of a part is its longest; pairs of like size are padded to it
            n, most = 1, len(items[by_size[0]])
            while n < min(256, len(by_size)) and (n + 1) * len(windows[by_size[n]]) * (m := max(most, len(items[by_size[n]]))) <= CELLS:
                n, most = n + 1, m
            part, by_size = by_size[:n], by_size[n:]
            s, l = smith_waterman([windows[i] for i in part], [items[i] for i in part])
            own = np.array([owner[i] for i in part])
            np.maximum.at(score, own, s)
            np.maximum.at(longest, own, l)
        n_words = np.array([len(w) for w in pdf["item_words"]], dtype=np.int32)
        yield pd.DataFrame({"doc_id": pdf["doc_id"], "eval_id": pdf["eval_id"], "score": score, "longest": longest, "item_words": n_words})


def find(docs: DataFrame, items: DataFrame, doc_id: str, doc_text: str, item_id: str, item_text: str, min_words: int = 12) -> DataFrame:
    """(doc_id, eval_id, score, longest, item_words) for every document and passage that share a seed.

    A seed is the rarest n-gram of ``min_words`` words of a passage.
    """
    spark = docs.sparkSession
    passages = items.select(F.col(f"`{item_id}`").cast("long").alias("eval_id"), F.col(f"`{item_text}`").alias("text"))
    passages = passages.filter(F.col("eval_id").isNotNull() & F.col("text").isNotNull()).dropDuplicates(["eval_id"])
    passages = materialize(passages.mapInArrow(_hash_items, "eval_id long, words array<long>"), "passages")
    grams = materialize(passages.mapInArrow(_item_grams, "eval_id long, at int, gram long"), "grams")
    size = bitmap_bits(grams.count())
    # a bitmap of bounded size from each of a few tasks, whatever the number of passages
    maps = grams.select("gram").distinct().coalesce(8).mapInArrow(_bitmap_batches(size), "bits binary").toLocalIterator()
    bits = np.zeros(size // 8, dtype=np.uint8)
    for m in maps:
        bits |= np.frombuffer(m.bits, dtype=np.uint8)
    bc = spark.sparkContext.broadcast(bits.tobytes())

    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{doc_text}`").alias("text")).filter(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    hits = texts.mapInArrow(_hits(bc), "doc_id long, words array<long>, at array<int>, grams array<long>")
    hits = materialize(hits, "hits")
    places = hits.select("doc_id", F.explode(F.arrays_zip("at", "grams")).alias("p")).select("doc_id", F.col("p.at").alias("doc_at"), F.col("p.grams").alias("gram"))
    counts = places.groupBy("gram").agg(F.count("*").alias("n"))
    seeds = materialize(choose_seeds(grams, counts, min_words).withColumnRenamed("at", "item_at"), "seeds")
    met = places.join(_small(seeds), "gram")
    pairs = materialize(met.groupBy("doc_id", "eval_id").agg(F.collect_set(F.struct("doc_at", "item_at")).alias("s")), "pairs")
    pairs = pairs.select("doc_id", "eval_id", F.col("s.doc_at").alias("doc_at"), F.col("s.item_at").alias("item_at"))
    seeded = hits.join(_small(materialize(pairs.select("doc_id").distinct(), "seeded")), "doc_id", "left_semi")
    doc_words = seeded.select("doc_id", F.col("words").alias("doc_words")).dropDuplicates(["doc_id"])
    both = pairs.join(doc_words, "doc_id").join(_small(passages.withColumnRenamed("words", "item_words")), "eval_id")
    return both.select("doc_id", "eval_id", "doc_words", "item_words", "doc_at", "item_at").mapInPandas(_align, "doc_id long, eval_id long, score int, longest int, item_words int")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if a check of its bytes allows it."""
    return F.broadcast(df) if is_small(df) else df


def leaked(aligned: DataFrame, min_words: int = 12) -> DataFrame:
    """(doc_id, eval_id) of the pairs with ``min_words`` equal words in a row."""
    return aligned.filter(F.col("longest") >= min_words).select("doc_id", "eval_id").distinct()


def edited(aligned: DataFrame, least: int = EDITED_SCORE) -> DataFrame:
    """(doc_id, eval_id, score, share) of the pairs that align with a score of ``least``: copies, edited or not.

    ``share`` is the score's part of what the whole passage, unchanged, would have.
    """
    rated = aligned.filter(F.col("score") >= least)
    return rated.select("doc_id", "eval_id", "score", F.bround(F.col("score") / (MATCH * F.col("item_words")), 4).alias("share"))

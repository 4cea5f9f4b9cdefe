"""Long exact spans shared between records, by recompression.

Every text is rewritten in rounds. A round first names each maximal run of one
symbol, then parts the symbols in two halves by a bit of their name and names
each pair of a left-half symbol followed by a right-half one. A name is a 64-bit
mix of what it stands for, so all tasks give equal runs and pairs one name
without exchanging tables, and equal substrings get equal symbols but for a few
at their two ends. Symbols that stand for ``SYMBOL`` characters or more take no
further part. Sequences of final symbols that span ``KEY`` characters are the
keys. Of any ``WINDOW`` keys in a row only the one of the smallest name is
kept: a common substring of ``min_chars`` holds more keys in a row than that, so
both texts keep the same one.

Only keys found in two different texts go on. Texts that share a key are
compared character by character along the diagonal the key gives; so names need
no proof of their own. Equal texts are one class and compared once.

Keys in more than ``FEW`` texts would give too many pairs. Their occurrences are
instead joined on fingerprints of all windows of ``min_chars`` that contain the
key: those are exactly the pairs to report, whatever is shared besides.

Runs that reach ``RUN`` characters can be cut anywhere by the end of a common
substring. Every window that touches such a run gives a fingerprint too, so what
texts share there is found without keys.

Defined cases: null texts and texts shorter than ``min_chars`` share nothing; a
text repeated under another id is wholly shared if long enough; repeated rows
(same id and text) are one record; null ids and empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup_stored
from ledgerloom.storage import materialize

SYMBOL, KEY, ROUNDS, FEW = 8, 84, 26, 24
WINDOW, RUN = 12, 20
#: ids of the texts to compare are broadcast up to this count, 8 bytes each; beyond it they are joined by a shuffle
BROADCAST_IDS = 200_000
CHUNK_CHARS = 1 << 20
#: records of a class whose pairs are too many for one task, and the tasks they are given to
BIG_CLASS, SALTS = 500, 32

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE, _MASK = np.uint64(0x9E3779B97F4A7C15), (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * _M1
    x ^= x >> np.uint64(29)
    x *= _M2
    x ^= x >> np.uint64(32)
    return x


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def recompress(points: np.ndarray, ends: np.ndarray, symbol: int = SYMBOL, rounds: int = ROUNDS, run: int = RUN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, starts, long run) of the final symbols of the texts that lie in ``points`` up to ``ends``."""
    names = _mix(points.astype(np.uint64) + _BASE)
    lens = np.ones(len(points), dtype=np.int32)
    # the last symbol of each text never joins the next text's first
    last = np.zeros(len(points), dtype=bool)
    last[ends[ends > 0] - 1] = True
    runs = np.zeros(len(points), dtype=bool)
    for r in range(rounds):
        open_ = lens < symbol
        if r % 2 == 0 or r < 6:
            same = np.zeros(len(names), dtype=bool)
            same[1:] = (names[1:] == names[:-1]) & open_[1:] & ~last[:-1]
            if same.any():
                first = np.flatnonzero(~same)
                count = np.diff(np.append(first, len(names)))
                many = count > 1
                final = np.append(first[1:], len(names)) - 1
                last, lens, runs = last[final], lens[first] * count.astype(np.int32), runs[first]
                names = names[first]
                names[many] = _mix(names[many] + count[many].astype(np.uint64) * _BASE)
                runs |= many & (lens >= run)
                open_ = lens < symbol
        right = (_mix(names + np.uint64((2 * r + 1) * int(_M2) & _MASK)) >> np.uint64(63)).astype(bool)
        pair = np.zeros(len(names), dtype=bool)
        pair[:-1] = ~right[:-1] & right[1:] & open_[:-1] & open_[1:] & ~last[:-1]
        at = np.flatnonzero(pair)
        if len(at):
            names[at] = _mix(names[at] * _M1 + names[at + 1] * _M2 + _BASE)
            lens[at] += lens[at + 1]
            last[at] = last[at + 1]
            runs[at] |= runs[at + 1]
            keep = np.ones(len(names), dtype=bool)
            keep[at + 1] = False
            names, lens, last, runs = names[keep], lens[keep], last[keep], runs[keep]
    starts = np.cumsum(lens, dtype=np.int64) - lens
    return names, starts, runs


def keys(names: np.ndarray, starts: np.ndarray, ends: np.ndarray, span: int = KEY) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, start, text) for each symbol from which a whole sequence of ``span`` characters or more lies in its text."""
    if not len(names):
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    n = len(names)
    power = np.cumprod(np.full(n + 1, _BASE | np.uint64(1), dtype=np.uint64))
    total = np.concatenate(([np.uint64(0)], np.cumsum(names * power[:n], dtype=np.uint64)))
    text = np.searchsorted(ends, starts, side="right")
    # the first symbol that starts span characters on or later, or the text's end
    after = np.searchsorted(starts, starts + span, side="left")
    stop = np.append(starts, ends[-1])[after]
    whole = stop <= ends[text]
    inverse = pow(int(_BASE | np.uint64(1)), -1, 1 << 64)
    back = np.cumprod(np.full(n + 1, inverse, dtype=np.uint64))
    key = _mix((total[after] - total[:n]) * back[:n])
    return key[whole], starts[whole], text[whole]


def kept(key: np.ndarray, text: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Places of the keys that are the smallest of some ``window`` keys in a row of their text; all keys of a text with fewer."""
    chosen = np.zeros(len(key), dtype=bool)
    _, first, count = np.unique(text, return_index=True, return_counts=True)
    for at, n in zip(first[count < window], count[count < window]):
        chosen[at : at + n] = True
    if len(key) >= window:
        inside = np.flatnonzero(text[: len(key) - window + 1] == text[window - 1 :])
        smallest = np.lib.stride_tricks.sliding_window_view(key, window).argmin(axis=1)
        chosen[inside + smallest[inside]] = True
    return np.flatnonzero(chosen)


def windows(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit fingerprints of every window of ``size`` characters."""
    n = len(points) - size + 1
    out = []
    for seed in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        level, width, at, left, got = _mix(points.astype(np.uint64) + seed), 1, 0, size, None
        while left:
            if left & 1:
                part = level[at : at + n]
                got = part.copy() if got is None else _mix(got * _M2 + part + seed)
                at += width
            left >>= 1
            if left:
                level = _mix(level[:-width] * _M1 + level[width:] * _M2 + seed)
                width *= 2
        out.append(got)
    return out[0], out[1]


def common_spans(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray, min_chars: int) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of the maximal common substrings on the diagonals start a - start b."""
    found = []
    for d in np.unique(diagonals):
        i, j = max(0, int(d)), max(0, -int(d))
        m = min(len(a) - i, len(b) - j)
        if m < min_chars:
            continue
        differ = np.flatnonzero(a[i : i + m] != b[j : j + m])
        edges = np.concatenate(([-1], differ, [m]))
        gaps = np.diff(edges) - 1
        for k in np.flatnonzero(gaps >= min_chars):
            s = int(edges[k]) + 1
            found.append((i + s, j + s, int(gaps[k])))
    return found


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and code points of texts, some ``size`` characters at a time."""
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
            points = code_points(t.as_py())
            ids.append(i)
            texts.append(points)
            held += len(points)
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def _emit_keys(min_chars: int):
    """(key, id, pos): the kept keys of each text, even; fingerprints of the windows that touch a long run, odd."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        even, odd = np.uint64(_MASK - 1), np.uint64(1)
        for ids, texts in _chunks(batches, CHUNK_CHARS):
            lengths = np.array([len(t) for t in texts], dtype=np.int64)
            ends = np.cumsum(lengths)
            names, starts, runs = recompress(np.concatenate(texts), ends)
            key, pos, text = keys(names, starts, ends)
            at = kept(key, text)
            key, pos, text = key[at], pos[at], text[at]
            owner, begins = np.array(ids, dtype=np.int64), ends - lengths
            parts = [(key & even, owner[text], pos - begins[text])]
            stops = np.append(starts[1:], ends[-1] if len(ends) else 0)
            run_text = np.searchsorted(ends, starts[runs], side="right")
            for t in np.unique(run_text):
                every = windows(texts[t], min_chars)[0] | odd
                touched = np.zeros(len(every), dtype=bool)
                for low, high in zip(starts[runs][run_text == t] - begins[t], stops[runs][run_text == t] - begins[t]):
                    touched[max(0, low - min_chars + 1) : high] = True
                at = np.flatnonzero(touched)
                parts.append((every[at], np.full(len(at), ids[t], dtype=np.int64), at))
            key, owner, pos = (np.concatenate(c) for c in zip(*parts))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(owner), pa.array(pos.astype(np.int32))], ["key", "id", "pos"])

    return run


def _expand_windows(min_chars: int):
    """All windows around the occurrences of frequent keys; first: not the same as an earlier one of the text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for rep, text, places in zip(pdf["rep"], pdf["text"], pdf["places"]):
                points = code_points(text)
                wanted = np.zeros(len(points) - min_chars + 1, dtype=bool)
                for p in places:
                    wanted[max(0, p + KEY - min_chars) : p + 1] = True
                at = np.flatnonzero(wanted)
                h1, h2 = windows(points, min_chars)
                out = pd.DataFrame({"h1": h1[at].view(np.int64), "h2": h2[at].view(np.int64), "rep": rep, "pos": at.astype(np.int32)})
                yield out.assign(first=~out.duplicated(["h1", "h2"]))

    return run


def _verify(min_chars: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for a, b, ta, tb, diagonals in zip(pdf["rep_a"], pdf["rep_b"], pdf["text_a"], pdf["text_b"], pdf["diagonals"]):
                for s in common_spans(code_points(ta), code_points(tb), np.asarray(diagonals), min_chars):
                    rows.append((a, b, *s))
            yield pd.DataFrame(rows, columns=["rep_a", "rep_b", "start_a", "start_b", "length"]).astype({"rep_a": "int64", "rep_b": "int64", "start_a": "int32", "start_b": "int32", "length": "int32"})

    return run


def text_classes(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(id, rep) for the texts long enough: the smallest id with the same text stands for all."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.filter(F.col("id").isNotNull() & (F.length("text") >= min_chars))
    hashed = rows.select("id", F.unhex(F.sha2("text", 256)).alias("h"))
    copied = hashed.groupBy("h").agg(F.min("id").alias("rep"), F.max("id").alias("last")).filter("rep < last").select("h", "rep")
    return lookup_stored(hashed, materialize(copied, "copied"), "h", "left").select("id", F.coalesce("rep", "id").alias("rep")).distinct()


def _ids_semi_join(texts: DataFrame, ids: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    return texts.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, key, how)


def shared_spans(df: DataFrame, id_col: str, text_col: str, min_chars: int = 300) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(classes, spans, wide).

    classes: as ``text_classes``. spans: (rep_a, rep_b, start_a, start_b,
    length) between different texts. wide: (rep, pos), windows of frequent
    passages and of texts with long runs that stand in another text too.
    """
    classes = materialize(text_classes(df, id_col, text_col, min_chars), "classes")
    copies = materialize(classes.filter("id <> rep"), "copies")
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")).filter(F.col("id").isNotNull() & (F.length("text") >= min_chars))
    # a class of equal texts is one text: copies are left out where they lie, or else renamed once few keys are left
    few_copies = copies.count() <= BROADCAST_IDS
    own = texts.join(F.broadcast(copies.select("id")), "id", "left_anti") if few_copies else texts
    found = materialize(own.mapInArrow(_emit_keys(min_chars), "key long, id long, pos int"), "keys")
    several = found.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).filter("low < high")
    if few_copies:
        # two texts, each once a key: nothing to count again
        shared = materialize(found.join(several.select("key", "n"), "key").withColumnRenamed("id", "rep"), "shared")
    else:
        renamed = found.join(several.select("key"), "key").join(copies, "id", "left").withColumn("rep", F.coalesce("rep", "id"))
        occurrences = materialize(renamed.select("key", "rep", "pos").distinct(), "occurrences")
        counts = occurrences.groupBy("key").agg(F.count("*").alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
        shared = materialize(occurrences.join(counts.select("key", "n"), "key"), "shared")
    involved = materialize(shared.select("rep").distinct(), "involved")
    texts = materialize(_ids_semi_join(texts.withColumnRenamed("id", "rep"), involved, "rep"), "texts")

    is_window = F.col("key").bitwiseAND(F.lit(1)) == 1
    at_windows = shared.filter(is_window)
    # a window that a text holds again and again is compared from its first place only
    once = at_windows.groupBy("key", "rep", "n").agg(F.min("pos").alias("pos"))
    anchors = shared.filter(~is_window).select("key", "rep", "pos", "n").unionByName(once.select("key", "rep", "pos", "n"))

    few = anchors.filter(F.col("n") <= FEW)
    left = few.select("key", F.col("rep").alias("rep_a"), F.col("pos").alias("pos_a"))
    right = few.select("key", F.col("rep").alias("rep_b"), F.col("pos").alias("pos_b"))
    near = left.join(right, "key").filter("rep_a < rep_b").select("rep_a", "rep_b", (F.col("pos_a") - F.col("pos_b")).alias("d"))

    # frequent keys: all windows around them. Windows with one set of texts are told apart by nothing, so one of them stands for all
    many = anchors.filter(F.col("n") > FEW)
    places = many.filter(~is_window).groupBy("rep").agg(F.collect_set("pos").alias("places"))
    wide = places.join(texts, "rep").mapInPandas(_expand_windows(min_chars), "h1 long, h2 long, rep long, pos int, first boolean")
    runs = many.filter(is_window).select(F.col("key").alias("h1"), F.lit(0).cast("long").alias("h2"), "rep", "pos", F.lit(True).alias("first"))
    wide = materialize(wide.unionByName(runs), "windows")
    firsts = wide.filter("first")
    sets = firsts.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("rep").alias("low"), F.max("rep").alias("high"), F.expr("bit_xor(xxhash64(rep))").alias("x")).filter("low < high")
    chosen = sets.groupBy("n", "low", "high", "x").agg(F.min(F.struct("h1", "h2")).alias("w")).select("w.h1", "w.h2")
    kept = firsts.join(chosen, ["h1", "h2"])
    a = kept.select("h1", "h2", F.col("rep").alias("rep_a"), F.col("pos").alias("pos_a"))
    b = kept.select("h1", "h2", F.col("rep").alias("rep_b"), F.col("pos").alias("pos_b"))
    hot = a.join(b, ["h1", "h2"]).filter("rep_a < rep_b").select("rep_a", "rep_b", (F.col("pos_a") - F.col("pos_b")).alias("d"))

    candidates = near.unionByName(hot).groupBy("rep_a", "rep_b").agg(F.collect_set("d").alias("diagonals"))
    both = candidates.join(texts.select(F.col("rep").alias("rep_a"), F.col("text").alias("text_a")), "rep_a")
    both = both.join(texts.select(F.col("rep").alias("rep_b"), F.col("text").alias("text_b")), "rep_b")
    # a repeated row gives its spans again
    spans = both.mapInPandas(_verify(min_chars), "rep_a long, rep_b long, start_a int, start_b int, length int").distinct()
    frequent = wide.join(sets.select("h1", "h2"), ["h1", "h2"], "left_semi").select("rep", "pos").unionByName(at_windows.select("rep", "pos"))
    return classes, materialize(spans, "spans"), frequent


def pairs(classes: DataFrame, spans: DataFrame, big: int = BIG_CLASS, salts: int = SALTS) -> DataFrame:
    """(doc_a, doc_b): all pairs of records that share a span, copies included.

    The pairs of a class of more than ``big`` records are made by ``salts``
    tasks, each of which meets all records of the class with a part of them.
    """
    sizes = materialize(classes.groupBy("rep").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    width = F.when(F.col("n") > big, F.lit(salts)).otherwise(F.lit(1))
    sized = lookup_stored(classes, sizes, "rep", "left").withColumn("width", width)
    part = lambda id_col, w: F.pmod(F.xxhash64(id_col), w).cast("int")
    b = sized.select(F.col("id").alias("id_b"), F.col("rep").alias("rep_b"), F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("salt"))
    a = sized.filter("n > 1").select(F.col("id").alias("id_a"), F.col("rep").alias("rep_b"), part("id", F.col("width")).alias("salt"))
    inside = a.join(b, ["rep_b", "salt"]).filter("id_a < id_b").select("id_a", "id_b")
    linked = lookup_stored(spans.select("rep_a", F.col("rep_b").alias("rep")).distinct(), sizes, "rep", "left").select("rep_a", F.col("rep").alias("rep_b"), width.alias("width"))
    firsts = classes.select(F.col("id").alias("id_a"), F.col("rep").alias("rep_a"))
    across = linked.join(firsts, "rep_a").withColumn("salt", part("id_a", F.col("width"))).join(b, ["rep_b", "salt"]).select("id_a", "id_b")
    every = across.unionByName(inside)
    return every.select(F.least("id_a", "id_b").alias("doc_a"), F.greatest("id_a", "id_b").alias("doc_b")).distinct()


def shared_share(df: DataFrame, id_col: str, text_col: str, classes: DataFrame, spans: DataFrame, wide: DataFrame, min_chars: int = 300) -> DataFrame:
    """(id, n_chars, shared_chars): how much of each record stands in another one too."""
    ends = spans.select(F.col("rep_a").alias("rep"), F.col("start_a").alias("s"), (F.col("start_a") + F.col("length")).alias("e"))
    ends = ends.unionByName(spans.select(F.col("rep_b").alias("rep"), F.col("start_b").alias("s"), (F.col("start_b") + F.col("length")).alias("e")))
    ends = ends.unionByName(wide.select("rep", F.col("pos").alias("s"), (F.col("pos") + min_chars).alias("e"))).distinct()
    before = Window.partitionBy("rep").orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.greatest(F.lit(0), F.col("e") - F.greatest("s", F.coalesce(F.max("e").over(before), F.lit(0))))
    covered = ends.withColumn("new", fresh).groupBy("rep").agg(F.sum("new").alias("covered"))
    copies = classes.groupBy("rep").agg(F.count("*").alias("copies"))
    lengths = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.length(f"`{text_col}`").alias("n_chars")).filter(F.col("id").isNotNull()).groupBy("id").agg(F.max("n_chars").alias("n_chars"))
    of = classes.join(copies, "rep").join(covered, "rep", "left")
    shared = lengths.join(of, "id", "left")
    chars = F.when(F.col("copies") > 1, F.col("n_chars")).otherwise(F.coalesce("covered", F.lit(0)))
    return shared.select("id", F.coalesce("n_chars", F.lit(0)).cast("long").alias("n_chars"), chars.cast("long").alias("shared_chars"))

"""Text decoded with a wrong character encoding: which values, by which chain, and the original.

A chain is a list of steps (right encoding, wrong encoding); text garbled twice
has two. A multinomial classifier over hashed byte bigrams (neighbouring bytes
and bytes two apart, which in two-byte scripts are neighbouring letters) is
trained on words of the corpus itself: as they are for the class "clean", and
garbled synthetically by each chain for the others. Every class has a row of
log probabilities for each script of the original words.

The classifier decides first: a word goes on only if some chain is likelier than
"clean", or nearly as likely and the original far more frequent. These chains
are inverted, and one counts only if the inversion decodes strictly and gives
letters of one script. Strict UTF-8 verifies by itself, since right text
practically never is UTF-8 under a wrong encoding, so of several verified chains
those through UTF-8 come first. Single-byte decoding never fails, so there the
original must also be the more usual word. Classes that lose bytes cannot be
inverted: they count if they win by far or a trace of the loss is left, such as
half of a UTF-8 letter. A replacement character is a trace by itself, and single
signs, too short to be scored, go by their frequencies.

One bounded sample reaches the driver, for the fit: the ``TRAIN_WORDS`` most
frequent words, ties by hash. Words are counted over all values and scored once
each, many at a time; what is found is joined back to the values.

Defined cases: null and empty values and values of ASCII only are clean; a
value garbled in places is restored in places; where nothing decodes strictly
(bytes were lost), ``restored`` is null; values of any length are read whole;
words longer than ``TRAIN_LETTERS`` are scored but not trained on; repeated rows
stay repeated; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup, lookup_stored
from ledgerloom.storage import materialize

TRAIN_WORDS, TRAIN_LETTERS = 40_000, 64
DIMENSIONS = 1 << 15
#: larger corpora are scaled to so many words before the fit
FORMS_OF = 200_000
#: a chain must beat "clean" by MARGIN, and the original be more usual than the word by GAIN
MARGIN, GAIN = 1.0, 6.0
#: a chain that falls short of "clean" by no more than NEAR is tried too: a far more frequent original makes up for it
NEAR = 12.0
#: a chain that falls short of the likeliest class by more than FAR is not tried
FAR = 40.0
#: where bytes were lost nothing can be inverted: the chain must win by more, and the word be unusual, or by twice that
LOSSY_MARGIN, UNUSUAL = 10.0, -8.0

Step = tuple[str, str]
Chain = tuple[Step, ...]

_WIDE = ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1251", "cp1253", "cp1254", "cp1255", "cp1256", "cp1257", "cp437", "cp850", "cp862", "cp866", "mac_roman", "koi8-r")
#: fixed values: pairs of single-byte encodings that are confused in practice
_NARROW = (
    *(("cp1255", w) for w in ("cp1252", "cp1251", "cp1250", "cp1253", "koi8-r", "mac_roman", "cp437", "cp862")),
    *(("cp1251", w) for w in ("cp1252", "koi8-r", "cp866", "mac_roman", "cp1250", "cp1253", "cp437", "cp1255")),
    *(("koi8-r", w) for w in ("cp1251", "cp1252", "cp866", "mac_roman", "cp1255")),
    *(("cp866", w) for w in ("cp1251", "cp1252", "koi8-r")),
    *(("cp862", w) for w in ("cp1252", "cp1255", "cp437")),
    *(("cp1252", w) for w in ("latin-1", "mac_roman", "cp437", "cp850", "cp1255", "cp1251", "cp1253", "cp1250", "koi8-r", "cp866", "cp862")),
    *(("mac_roman", w) for w in ("cp1252", "cp437", "cp850")),
    *(("cp437", w) for w in ("cp1252", "mac_roman")),
    *(("cp850", w) for w in ("cp1252", "mac_roman")),
)
CHAINS: tuple[Chain, ...] = (
    *((("utf-8", w),) for w in _WIDE),
    *((("utf-8", w), ("utf-8", w)) for w in ("cp1252", "latin-1", "cp1251", "cp1253", "cp1255", "cp437", "mac_roman")),
    *(((t, w),) for t, w in _NARROW),
)
#: chains whose undefined bytes are lost; they can be recognised but not inverted
LOSSY: tuple[Chain, ...] = tuple((("utf-8", w),) for w in ("cp1252", "latin-1", "cp1250", "iso8859-2", "cp1253", "cp1255"))
LOST = "�"
#: a word more frequent in the sample than this must give a more frequent one to count as garbled
COMMON = 3
#: a single sign counts as garbled if it stands for one that is so many times as frequent
LONE = 30


@functools.lru_cache(maxsize=64)
def _undefined(encoding: str) -> list[bool]:
    flags = []
    for b in range(256):
        try:
            bytes([b]).decode(encoding)
            flags.append(False)
        except UnicodeError:
            flags.append(True)
    return flags


def to_bytes(text: str, encoding: str) -> bytes | None:
    """The bytes that a decoder for ``encoding`` turned into ``text``.

    Decoders pass bytes that a code page leaves undefined as the characters of the same number.
    """
    try:
        return text.encode(encoding)
    except UnicodeError:
        pass
    out = bytearray()
    for c in text:
        try:
            out += c.encode(encoding)
        except UnicodeError:
            if not 0x80 <= ord(c) < 0x100 or not _undefined(encoding)[ord(c)]:
                return None
            out.append(ord(c))
    return bytes(out)


def from_bytes(data: bytes, encoding: str, errors: str = "c1") -> str:
    """``data`` as a wrong decoder shows it; undefined bytes become C1 controls, U+FFFD or nothing."""
    if errors != "c1":
        return data.decode(encoding, errors)
    try:
        return data.decode(encoding)
    except UnicodeError:
        out = []
        for b in data:
            try:
                out.append(bytes([b]).decode(encoding))
            except UnicodeError:
                out.append(chr(b))
        return "".join(out)


def garble(text: str, chain: Chain, errors: str = "c1") -> str | None:
    for right, wrong in chain:
        try:
            data = text.encode(right)
        except UnicodeError:
            return None
        text = from_bytes(data, wrong, errors)
    return text


def invert(text: str, chain: Chain) -> str | None:
    """The text before the chain, or null if a step does not decode strictly."""
    for right, wrong in reversed(chain):
        data = to_bytes(text, wrong)
        if data is None:
            return None
        try:
            text = data.decode(right)
        except UnicodeError:
            return None
    return text


@functools.lru_cache(maxsize=8192)
def _script(c: str) -> str:
    """Script of a letter; "" for what goes with any script, "?" for what real text hardly holds."""
    if c.isascii():
        return "latin" if c.isalpha() else "" if c.isprintable() else "?"
    o, kind = ord(c), unicodedata.category(c)
    if kind[0] == "L":
        if o in (0xAA, 0xBA):
            return ""
        if 0xC0 <= o < 0x180:
            return "latin"
        if 0x386 <= o < 0x3CF:
            return "greek"
        if 0x401 <= o <= 0x45F or o in (0x490, 0x491):
            return "cyrillic"
        if 0x5D0 <= o < 0x5EB:
            return "hebrew"
        return "?"
    if 0x591 <= o < 0x5C8 or o in (0x5F3, 0x5F4):
        return "hebrew"
    if 0xA0 <= o < 0xC0 and o not in (0xA8, 0xAD, 0xAF, 0xB4, 0xB8) or o in (0xD7, 0xF7, 0x20AC, 0x2116, 0x2122) or 0x2010 <= o < 0x2040 and o not in (0x2028, 0x2029):
        return ""
    return "?"


def readable(text: str) -> bool:
    """Letters of one script, and nothing that real text hardly holds."""
    scripts = {_script(c) for c in text}
    return "?" not in scripts and len(scripts - {""}) <= 1


#: scripts of a word's letters; "none" has no letters, "mixed" those of several scripts
SCRIPTS = ("latin", "hebrew", "cyrillic", "greek", "none", "mixed")


def _word_script(word: str) -> str:
    scripts = {_script(c) for c in word} - {"", "?"}
    return scripts.pop() if len(scripts) == 1 else "mixed" if scripts else "none"


_RUN = re.compile(r"[^\x00-\x7f]+")
_SPACE = re.compile(r"[ \t\r\n]+")


def _utf8_run(run: str, chain: Chain) -> str | None:
    """The text of a run if it is UTF-8 under the chain's wrong encoding and reads as one script."""
    text = invert(run, chain)
    return text if text and text != run and not text.isascii() and readable(text) else None


_UTF8 = tuple(c for c in CHAINS if c[0][0] == "utf-8")


def _partial_utf8(run: str) -> bool:
    """Whether a run holds UTF-8 under one wrong encoding of which some bytes were lost.

    Either two or more whole letters are left, or the first two bytes of a
    general punctuation mark, which no right text has side by side.
    """
    for chain in _UTF8:
        if len(chain) > 1:
            continue
        data = to_bytes(run, chain[0][1])
        if data is None:
            continue
        if b"\xe2\x80" in data:
            return True
        text = data.decode("utf-8", "ignore")
        kept = len(text.encode("utf-8"))
        if len(text) >= 2 and kept >= 0.6 * len(data) and not any(c.isascii() for c in text):
            if readable(text) and any(_script(c) for c in text) or any(_utf8_run(r, c) for r in _RUN.findall(text) for c in _UTF8):
                return True
    return False


def _covers(encoding: str) -> tuple[str, ...]:
    """Scripts whose words can be written in an encoding."""
    if encoding == "utf-8":
        return SCRIPTS[:-1]
    return {"cp1255": ("hebrew",), "cp862": ("hebrew",), "cp1251": ("cyrillic",), "koi8-r": ("cyrillic",), "cp866": ("cyrillic",)}.get(encoding, ("latin", "none"))


#: (kind, place in CHAINS or LOSSY, script of the original): the rows of the model, in three blocks
CLASSES: tuple[tuple[str, int, str], ...] = (
    *(("clean", -1, s) for s in SCRIPTS),
    *(("chain", i, s) for i, c in enumerate(CHAINS) for s in _covers(c[0][0])),
    *((kind, i, s) for kind in ("dropped", "replaced") for i, c in enumerate(LOSSY) for s in _covers(c[0][0])),
)
_FIRST_CHAIN, _FIRST_LOSSY = len(SCRIPTS), next(i for i, c in enumerate(CLASSES) if c[0] == "dropped")
_CHAIN_STARTS = np.flatnonzero(np.diff([-1, *(c[1] for c in CLASSES[_FIRST_CHAIN:_FIRST_LOSSY])]))
#: pairs whose rows of the model are held at once
PAIRS_AT_ONCE = 1 << 16
#: log probability in a class that has no words
NEVER = -30.0


def _features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hashed pair, place of its word): pairs of neighbouring bytes and of bytes two apart, word by word."""
    parts = [b"  " + w.encode("utf-8", "surrogatepass") + b"  " for w in words]
    x = np.frombuffer(b"".join(parts), dtype=np.uint8).astype(np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    near, far = owner[:-1] == owner[1:], owner[:-2] == owner[2:]
    key = np.concatenate([(x[:-1] * np.uint32(256) + x[1:])[near], (x[:-2] * np.uint32(256) + x[2:] + np.uint32(1 << 16))[far]])
    owner = np.concatenate([owner[:-1][near], owner[:-2][far]])
    order = np.argsort(owner, kind="stable")
    return (key * np.uint32(2654435761) >> np.uint32(16) & np.uint32(DIMENSIONS - 1))[order], owner[order]


@dataclass
class Scores:
    """Of one word: by how much each chain and the best lossy class beat "clean", and how usual its pairs are in right words."""

    chains: np.ndarray
    lossy: float
    usual: float

    @property
    def suspect(self) -> bool:
        return self.lossy > 0 or bool((self.chains > -NEAR).any())


@dataclass
class Model:
    """Log probabilities of the hashed pairs, a column for each of ``CLASSES``; counts of words over all values."""

    weights: np.ndarray
    counts: dict[str, int]

    def score(self, words: Sequence[str], at_once: int = 2000) -> Iterator[Scores]:
        for at in range(0, len(words), at_once):
            part = list(words[at : at + at_once])
            # capitals are rare; what is usual in small letters is usual
            small = [w.lower() if w.isupper() else w for w in part]
            sums, pairs = self._sums(part)
            low, low_pairs = self._sums(small) if small != part else (sums, pairs)
            for i, w in enumerate(part):
                script = SCRIPTS.index(_word_script(w))
                own = sums[i, script]
                if low_pairs[i] == pairs[i]:
                    own = max(own, low[i, script])
                chains = np.maximum.reduceat(sums[i, _FIRST_CHAIN:_FIRST_LOSSY], _CHAIN_STARTS) - own
                yield Scores(chains, float(sums[i, _FIRST_LOSSY:].max() - own), float(own / pairs[i]))

    def _sums(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        keys, owner = _features(words)
        sums = np.zeros((len(words), len(CLASSES)), dtype=np.float32)
        # a long word has many pairs, so they are added up some at a time
        for at in range(0, len(keys), PAIRS_AT_ONCE):
            own = owner[at : at + PAIRS_AT_ONCE]
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            sums[own[starts]] += np.add.reduceat(self.weights[keys[at : at + PAIRS_AT_ONCE]].astype(np.float32), starts, axis=0)
        return sums, np.bincount(owner)

    def clean(self, word: str) -> float:
        keys, _ = _features([word])
        return float(self.weights[keys, SCRIPTS.index(_word_script(word))].mean(dtype=np.float32))


@functools.lru_cache(maxsize=64)
def _shown(encoding: str) -> dict[int, str]:
    """What a decoder for ``encoding`` shows for each byte."""
    return {b: from_bytes(bytes([b]), encoding) for b in range(256)}


def _garble_words(words: list[str], chain: Chain) -> tuple[list[str], np.ndarray]:
    """(the words that the chain can be applied to, garbled; their places); those it leaves ASCII are left out."""
    out, at = words, np.arange(len(words))
    for right, wrong in chain:
        if right != "utf-8":
            letters = {c for w in out for c in w}
            known = {c for c in letters if c.encode(right, "ignore")}
            kept = [known.issuperset(w) for w in out]
            out, at = [w for w, k in zip(out, kept) if k], at[np.array(kept, dtype=bool)]
        if not out:
            return [], at
        # the line feed is the same byte in all encodings here
        data = "\n".join(out).encode(right, "surrogatepass" if right == "utf-8" else "strict")
        out = data.decode("latin-1").translate(_shown(wrong)).split("\n")
    kept = [not w.isascii() for w in out]
    return [w for w, k in zip(out, kept) if k], at[np.array(kept, dtype=bool)]


_C1 = re.compile("[\x80-\x9f]")


def _lost(word: str) -> bool:
    """A replacement character, or a C1 control, which only a wrong decoder leaves."""
    return LOST in word or _C1.search(word) is not None


#: nothing but ASCII and letters whose bytes are, in every encoding here, only lead or only trailing bytes of UTF-8
_NO_UTF8 = re.compile(r"[\x00-\x7f\u05d0-\u05ea\u0430-\u044f]*")


def _proven(word: str) -> bool:
    if _NO_UTF8.fullmatch(word):
        return False
    return _lost(word) or any(_utf8_run(r, c) for r in _RUN.findall(word) for c in _UTF8) or any(_partial_utf8(r) for r in _RUN.findall(word))


def fit_class(kind: str, which: int, script: str, groups: dict[str, tuple[list[str], np.ndarray]]) -> np.ndarray:
    """Log probabilities of one class from the right words of its script and their weights."""
    if script == "mixed":
        # words of several scripts are mostly what the search is for: nothing is usual in them
        return np.full(DIMENSIONS, -np.log(DIMENSIONS), dtype=np.float16)
    sample, weights = groups.get(script, ([], np.empty(0)))
    if kind == "chain":
        sample, at = _garble_words(sample, CHAINS[which])
        weights = weights[at]
    elif kind != "clean":
        sample, at = _garble_words(sample, LOSSY[which])
        sample, weights = [_C1.sub(LOST if kind == "replaced" else "", w) for w in sample], weights[at]
    if not sample:
        return np.full(DIMENSIONS, NEVER, dtype=np.float16)
    keys, owner = _features(sample)
    counts = np.bincount(keys, weights=weights[owner], minlength=DIMENSIONS) + 0.05
    return np.log(counts / counts.sum()).astype(np.float16)


def by_script(sample: list[str], weights: np.ndarray) -> dict[str, tuple[list[str], np.ndarray]]:
    """Right words parted by the script of their letters; what no right text holds is left out."""
    places: dict[str, list[int]] = {}
    for i, w in enumerate(sample):
        if readable(w):
            places.setdefault(_word_script(w), []).append(i)
    return {s: ([sample[i] for i in at], weights[at]) for s, at in places.items()}


def forms(words: dict[str, int], total: int) -> tuple[list[str], np.ndarray]:
    """Right words and their weights, which grow as the logarithm of the frequency; rare capital forms of frequent words are filled in.

    Frequencies are those in a corpus of ``FORMS_OF`` words if this one, of
    ``total``, is larger: garbled words grow in number with the corpus, and
    must not pass for right ones by that.
    """
    scale = min(1.0, FORMS_OF / max(1, total))
    out: dict[str, float] = {}
    for w, n in sorted(words.items()):
        out[w] = out.get(w, 0.0) + float(np.log2(1 + 3 * n * scale))
        if n * scale > 2:
            for form in (w.upper(), w.capitalize()):
                out[form] = out.get(form, 0.0) + 1.0
    return list(out), np.array(list(out.values()))


def fit(words: dict[str, int], total: int) -> np.ndarray:
    groups = by_script(*forms(words, total))
    return np.stack([fit_class(*c, groups) for c in CLASSES], axis=1)


def trusted_words(words: dict[str, int]) -> dict[str, int]:
    """The words that may teach what is clean: those without a proof of garbling."""
    return {w: n for w, n in words.items() if not w.isascii() and not _proven(w) and "\n" not in w}


def train(words: dict[str, int], rounds: int = 2, fitted=fit) -> Model:
    """A model from counted words of the corpus, some of which are garbled.

    Words with a proof of garbling are left out; each further round leaves out
    the words that the round before found.
    """
    known, total = trusted_words(words), sum(words.values())
    model = Model(fitted(known, total), dict(words))
    # signs without letters teach nothing until those that are the rest of garbled words are known
    model.weights[:, SCRIPTS.index("none")] = model.weights[:, SCRIPTS.index("mixed")]
    for _ in range(rounds - 1):
        listed = sorted(known)
        found = {w for w, s in zip(listed, model.score(listed)) if diagnose(w, model, s) is not None}
        if found:
            known = {w: n for w, n in known.items() if w not in found}
            model = Model(fitted(known, total), dict(words))
    return model


def _lone(word: str, model: Model) -> tuple[Chain, str] | None:
    """A single sign, like the one in "19 x 24", that some chain makes of a far more frequent one."""
    seen = max(1, model.counts.get(word, 0))
    best = None
    for chain in CHAINS:
        text = invert(word, chain)
        n = model.counts.get(text, 0) if text and text != word and len(text) == 1 else 0
        if n >= LONE * seen and (best is None or n > best[0]):
            best = (n, chain, text)
    return best[1:] if best else None


_LEADS = bytes(range(0xC2, 0xE0))


def _refilled(word: str, counts: dict[str, int], times: int = 1) -> bool:
    """Whether one lost byte, put back behind a UTF-8 lead byte, makes a word more than ``times`` as frequent."""
    for chain in LOSSY:
        data = to_bytes(word, chain[0][1])
        if data is None:
            continue
        try:
            data.decode("utf-8")
            continue
        except UnicodeDecodeError as e:
            at = e.start
        # what stands before the first error is right; the rest must be too but for the lost byte
        if data[at] not in _LEADS or at + 1 < len(data) and 0x80 <= data[at + 1] < 0xC0:
            continue
        try:
            before, after = data[:at].decode("utf-8"), data[at + 1 :].decode("utf-8")
        except UnicodeDecodeError:
            continue
        for filler in range(0x80, 0xA0):
            if counts.get(before + bytes([data[at], filler]).decode("utf-8") + after, 0) > times * counts.get(word, 0):
                return True
    return False


def _verified_utf8(word: str, chains: Sequence[int], model: Model) -> tuple[Chain, str] | None:
    """Of the predicted chains through UTF-8 the one that decodes strictly, the whole word or else its foreign runs."""
    utf8 = [CHAINS[i] for i in chains if CHAINS[i][0][0] == "utf-8"]
    whole = [(c, t) for c in utf8 if (t := invert(word, c)) and t != word and readable(t) and not t.isascii()]
    if whole:
        return max(whole, key=lambda h: (len(h[0]), model.clean(h[1]), -CHAINS.index(h[0])))
    runs = _RUN.findall(word)
    for chain in utf8:
        fixed = [_utf8_run(r, chain) for r in runs]
        if any(fixed):
            done = iter(f or r for f, r in zip(fixed, runs))
            return chain, _RUN.sub(lambda _: next(done), word)
    return None


def diagnose(word: str, model: Model, scores: Scores | None = None) -> tuple[Chain | None, str | None] | None:
    """(chain, original) of a garbled word, either null where bytes were lost; null for a clean word."""
    if word.isascii():
        return None
    if scores is None:
        scores = next(model.score([word]))
    tried = np.flatnonzero(scores.chains > max(-NEAR, max(scores.chains.max(), scores.lossy) - FAR))
    likely = tried[scores.chains[tried] > 0]
    likely = likely[np.argsort(-scores.chains[likely], kind="stable")]
    if len(likely) and not _NO_UTF8.fullmatch(word):
        found = _verified_utf8(word, likely, model)
        if found is not None:
            return found
    if LOST in word or scores.suspect and any(_partial_utf8(r) for r in _RUN.findall(word)):
        return None, None
    if len(word) == 1:
        # too few bytes to tell by: frequencies decide
        return _lone(word, model) or ((None, None) if scores.lossy > 0 and _refilled(word, model.counts, LONE) else None)
    if scores.lossy > 0 and _refilled(word, model.counts):
        return None, None
    foreign = sum(not c.isascii() for c in word)
    if foreign < 2 and sum(c.isalpha() for c in word) < 2 and not _lost(word):
        return None
    best = None
    for i in tried:
        text = invert(word, CHAINS[i])
        if text is None or text == word or not readable(text) or not any(c.isalpha() for c in text):
            continue
        before, after = model.counts.get(word, 0), model.counts.get(text, 0)
        if before > COMMON and after <= before:
            # right words are more frequent than their garbled forms
            continue
        if scores.chains[i] <= MARGIN and scores.chains[i] + 2 * np.log((after + 1) / (before + 1)) <= MARGIN:
            continue
        gain = (model.clean(text) - scores.usual) * (2 * len(word.encode("utf-8", "surrogatepass")) + 5) + 2 * np.log1p(after)
        if gain > GAIN and (best is None or gain > best[0]):
            best = (gain, CHAINS[i], text)
    if best and (_lost(word) or scores.chains[CHAINS.index(best[1])] >= scores.lossy or scores.lossy <= 0):
        return best[1:]
    if best:
        # a chain that loses bytes explains the word better than the one that can be undone
        return None, None
    strange = foreign > 1 and (not readable(word) or _word_script(word) == "none") or scores.usual < UNUSUAL
    if _lost(word) or scores.lossy > LOSSY_MARGIN and strange or scores.lossy > 2 * LOSSY_MARGIN:
        return None, None
    return None


def name(chain: Chain | None) -> str | None:
    return None if chain is None else " then ".join(f"{r} read as {w}" for r, w in chain)


def restore(value: str, model: Model, word_of=diagnose) -> tuple[bool, str | None, str | None]:
    """(garbled, chain, restored) of one value."""
    if value is None or value.isascii():
        return False, None, None
    parts = re.split(f"({_SPACE.pattern})", value)
    seen: Counter = Counter()
    whole, lost = [], False
    for p in parts:
        d = None if p.isascii() else word_of(p, model)
        if d is None:
            whole.append(p)
            continue
        seen[d[0]] += len(p)
        lost |= d[1] is None
        whole.append(d[1] if d[1] is not None else p)
    if not seen:
        return False, None, None
    chain = max((c for c in seen if c), key=seen.__getitem__, default=None)
    if chain is not None:
        # short words beside the ones found
        for i, p in enumerate(parts):
            if whole[i] == p and not p.isascii() and (t := invert(p, chain)) and t != p and readable(t) and model.clean(t) > model.clean(p):
                whole[i] = t
    return True, name(chain), None if lost else "".join(whole)


def _values(df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """(id, field, value) for the values that are not ASCII only."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields])).alias("p")
    values = df.select(F.col(f"`{id_col}`").alias("id"), pairs).select("id", "p.field", "p.value")
    return values.filter(F.col("value").rlike(r"[^\x00-\x7F]"))


def sample_words(words: DataFrame, bound: int = TRAIN_WORDS) -> dict[str, int]:
    """The ``bound`` most frequent of ``words`` (word, n), no longer than ``TRAIN_LETTERS``; ties by hash."""
    short = words.filter(F.length("word") <= TRAIN_LETTERS)
    taken = short.orderBy(F.desc("n"), F.xxhash64("word"), "word").limit(bound).toPandas()
    return dict(zip(taken["word"], taken["n"].tolist()))


def _fit_part(bc):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        groups = by_script(*bc.value)
        for pdf in batches:
            yield pd.DataFrame({"place": pdf["id"], "weights": [fit_class(*CLASSES[i], groups).tobytes() for i in pdf["id"]]})

    return run


def fit_on(spark: SparkSession):
    """``fit`` with the classes spread over the executors; each returns one row of ``DIMENSIONS`` numbers a class."""

    def fitted(words: dict[str, int], total: int) -> np.ndarray:
        bc = spark.sparkContext.broadcast(forms(words, total))  # bounded by TRAIN_WORDS and TRAIN_LETTERS
        parts = min(len(CLASSES), spark.sparkContext.defaultParallelism)
        rows = spark.range(0, len(CLASSES), 1, parts).mapInPandas(_fit_part(bc), "place long, weights binary").collect()
        out = np.empty((DIMENSIONS, len(CLASSES)), dtype=np.float16)
        for r in rows:
            out[:, r.place] = np.frombuffer(r.weights, dtype=np.float16)
        return out

    return fitted


class _Asked(dict):
    """Counts that know no word and keep the words asked for."""

    def get(self, word, default=None):
        self[word] = 0
        return default


def _ask(bc):
    """(word, text, chain, original): what the classifier predicts and strict UTF-8 verifies, decided at once, and of the other words it suspects every text whose count their diagnosis needs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            words = pdf["word"].tolist()
            for w, s in zip(words, Model(bc.value, {}).score(words)):
                if s.suspect or LOST in w or len(w) == 1:
                    # with no word known every later question is asked too
                    asked = _Asked()
                    d = diagnose(w, Model(bc.value, asked), s)
                    if d is not None and not asked:
                        rows.append((w, None, CHAINS.index(d[0]) if d[0] else -1, d[1]))
                    else:
                        rows += [(w, t, None, None) for t in {w, *asked}]
            yield pd.DataFrame(rows, columns=["word", "text", "chain", "original"]).astype({"chain": "Int32"})

    return run


def _diagnose(bc):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            words = pdf["word"].tolist()
            for w, known, s in zip(words, pdf["known"], Model(bc.value, {}).score(words)):
                d = diagnose(w, Model(bc.value, {k["text"]: k["n"] for k in known}), s)
                if d is not None:
                    rows.append((w, CHAINS.index(d[0]) if d[0] else -1, d[1]))
            yield pd.DataFrame(rows, columns=["word", "chain", "text"])

    return run


def _restore(bc):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(bc.value, {})
        for pdf in batches:
            got = []
            for v, found in zip(pdf["value"], pdf["found"]):
                by_word = {f["word"]: (CHAINS[f["chain"]] if f["chain"] >= 0 else None, f["text"]) for f in found}
                got.append(restore(v, model, lambda w, _: by_word.get(w)))
            pdf = pdf[["id", "field"]].assign(chain=[g[1] for g in got], restored=[g[2] for g in got])
            yield pdf[np.array([g[0] for g in got], dtype=bool)]

    return run


def _words(text: str = "value"):
    """The foreign words of a text, each once."""
    return F.explode(F.array_distinct(F.filter(F.split(text, _SPACE.pattern), lambda w: w.rlike(r"[^\x00-\x7F]")))).alias("word")


def count_words(values: DataFrame) -> DataFrame:
    """(word, n) of every word with a foreign character, counted over all of ``values``."""
    every = values.select(F.explode(F.split("value", _SPACE.pattern)).alias("word")).filter(F.col("word").rlike(r"[^\x00-\x7F]"))
    return every.groupBy("word").agg(F.count("*").alias("n"))


def diagnoses(values: DataFrame, bc, words: DataFrame | None = None) -> DataFrame:
    """(word, place of the chain or -1, original) of every garbled word of ``values``, by its counts over all of them (``words``)."""
    words = materialize(count_words(values), "words") if words is None else words
    # tasks follow the words, of which few files may hold many
    parts = words.sparkSession.sparkContext.defaultParallelism
    asked = materialize(words.select("word").repartition(parts, "word").mapInPandas(_ask(bc), "word string, text string, chain int, original string"), "asked")
    at_once = asked.filter("text IS NULL").select("word", "chain", F.col("original").alias("text"))
    open_ = asked.filter("text IS NOT NULL").select("word", "text")
    known = lookup(open_, words.withColumnRenamed("word", "text"), "text").groupBy("word").agg(F.collect_list(F.struct("text", "n")).alias("known"))
    later = known.repartition(parts, "word").mapInPandas(_diagnose(bc), "word string, chain int, text string")
    return materialize(at_once.unionByName(later), "diagnoses")


def find(df: DataFrame, id_col: str, fields: Sequence[str], train_words: int = TRAIN_WORDS) -> DataFrame:
    """(id, field, chain, restored) for every garbled value of ``fields``."""
    spark = df.sparkSession
    values = _values(df, id_col, fields)
    words = materialize(count_words(values), "words")
    bc = spark.sparkContext.broadcast(train(sample_words(words, train_words), fitted=fit_on(spark)).weights)  # DIMENSIONS x classes, 2 bytes each
    keyed = values.withColumn("key", F.sha2("value", 256))
    garbled = lookup_stored(keyed.select("key", _words()), diagnoses(values, bc, words), "word")
    by_value = materialize(garbled.distinct().groupBy("key").agg(F.collect_list(F.struct("word", "chain", "text")).alias("found")), "found")
    id_type = df.schema[id_col].dataType.simpleString()
    found = lookup_stored(keyed, by_value, "key").select("id", "field", "value", "found")
    return found.mapInPandas(_restore(bc), f"id {id_type}, field string, chain string, restored string").withColumnRenamed("id", id_col)

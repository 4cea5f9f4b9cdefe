"""Mapping of freely typed values to the entries of a canonical list.

An entry has an id, a name and aliases, most of them ending in a version. They
are parted into a family name and a version, and every family name is known in
the written forms people use for it: whole, with its last word left out or put
first, with long words cut short, as its initials. A multi-pattern automaton
over all forms finds the mentions embedded in a value; among overlapping ones
the longest wins. The version is the number next to the mention. What the
automaton leaves goes to token-set similarity: a form matches if each of its
words is found among the value's words up to a few typing errors, and wins if
it has more matched letters than any other and than the mention.

A value whose family is found but whose version is not on the list, and a value
that gives no version of a family with several, match nothing: they are
reported with the id of the "unknown" entry.

Matching is a narrow step: rows are handled in Arrow batches where they lie. A
worker holds one shard of ``shard_entries`` entries at a time (versions of one
family together). A longer list is run shard by shard over the distinct values,
the longest mention over all shards wins, and rows look up their values, hot
ones off the shuffle. A list of more than ``MOST_ENTRIES`` is refused.

Defined cases: null and blank values give null (no case), as does a value that
is an id, name or alias apart from case and surrounding white space; very long
values are searched whole; ties go to the entry that comes first in the list;
an empty list maps every value to "unknown".
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup_stored
from ledgerloom.storage import materialize

SHARD_ENTRIES = 20_000
#: entries that the driver reads: more are no curated list
MOST_ENTRIES = 1_000_000
LONG_WORD, CUT_TO = 7, 4

_VERSION_AT_END = re.compile(r"[\s-]*(\d+(?:\.\d+)*)\s*$")
_NUMBER = re.compile(r"\d+(?:\.\d+)*")
_INITIALS = re.compile(r"(?<!\w)(?:\w\.){2,}(?=\W|$)|(?<!\w)(?:\w\.){1,}\w(?!\w)")
_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+")


@dataclass(frozen=True)
class Entry:
    id: str
    name: str | None
    aliases: tuple[str, ...]


def plain(text: str) -> str:
    """Compatibility form, full case folding, combining marks off."""
    text = unicodedata.normalize("NFKC", text).casefold()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def words(text: str) -> list[str]:
    """Letter runs and numbers of a folded text; dotted initials become one word."""
    text = _INITIALS.sub(lambda m: m[0].replace(".", "") + " " if not any(c.isdigit() for c in m[0]) else m[0], text)
    return _WORD.findall(text)


def version_key(text: str) -> tuple[int, ...]:
    """A version without trailing zeros: 2, 2.0 and 2.0.0 are one."""
    parts = [int(p) for p in text.split(".")]
    while len(parts) > 1 and parts[-1] == 0:
        parts.pop()
    return tuple(parts)


def split_version(label: str) -> tuple[str, tuple[int, ...] | None]:
    m = _VERSION_AT_END.search(label)
    return (label[: m.start()], version_key(m[1])) if m and m.start() else (label, None)


def _edits(a: str, b: str, most: int) -> int:
    """Insertions, deletions, substitutions and swaps of neighbours; ``most + 1`` if more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            cost = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                cost = min(cost, before[j - 2] + 1)
            new.append(cost)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return row[-1]


MOST_EDITS = 3


def _allowed(word: str) -> int:
    return 0 if len(word) < 3 else 1 if len(word) < 5 else 2 if len(word) == 5 else MOST_EDITS


def _letters(word: str) -> int:
    """The letters of a word as bits; some share one."""
    bits = 0
    for c in word:
        bits |= 1 << (ord(c) & 127)
    return bits


class Matcher:
    """The forms of one shard of the list."""

    def __init__(self, entries: Sequence[Entry], unknown: str):
        self.unknown = unknown
        self.exact: set[str] = set()
        self.versions: dict[str, dict[tuple[int, ...] | None, str]] = {}
        forms: dict[tuple[str, ...], str] = {}
        for e in entries:
            labels = [x for x in (e.id, e.name, *e.aliases) if x]
            self.exact.update(x.strip().casefold() for x in labels)
            if e.id == unknown:
                continue
            family, version = split_version(e.id)
            family = plain(family)
            self.versions.setdefault(family, {}).setdefault(version, e.id)
            for label in labels:
                for v in self._variants(plain(split_version(label)[0])):
                    forms.setdefault(v, family)
        self.forms = sorted(forms.items(), key=lambda f: -sum(map(len, f[0])))
        self.automaton = self._automaton(forms)
        self.alone = {f[0]: family for f, family in forms.items() if len(f) == 1}
        self._near_cache: dict[str, tuple[tuple[str, int], ...]] = {}
        self.by_word: dict[str, list[int]] = defaultdict(list)
        #: words by length, with the letters they have
        self.by_length: dict[int, list[tuple[str, int]]] = defaultdict(list)
        for i, (form, _) in enumerate(self.forms):
            for w in set(form):
                self.by_word[w].append(i)
        for w in self.by_word:
            self.by_length[len(w)].append((w, _letters(w)))

    @staticmethod
    def _variants(label: str) -> Iterator[tuple[str, ...]]:
        """The written forms of a family name, as words."""
        for whole in dict.fromkeys((label, re.sub(r"\blicence\b", "license", label))):
            parts = whole.split()
            short = [w[:CUT_TO] if len(w) >= LONG_WORD else w for w in parts]
            orders = [parts, [w.replace("-", "") for w in parts], short]
            if len(parts) > 1:
                orders.append([parts[-1], *parts[:-1]])
            if len(parts) > 2:
                orders.append(parts[:-1])
            if len(parts) > 1 and parts[-1] in ("licence", "license"):
                orders += [[*parts[:-1], "lic"], [*short[:-1], "lic"]]
            for o in orders:
                if form := tuple(words(" ".join(o))):
                    yield form

    @staticmethod
    def _automaton(forms: dict[tuple[str, ...], str]):
        import ahocorasick

        a = ahocorasick.Automaton()
        for form, family in forms.items():
            text = f" {' '.join(form)} "
            a.add_word(text, (len(text), family))
        if forms:
            a.make_automaton()
        return a

    def _glued(self, word: str, following: list[str]) -> str | None:
        """The family whose initials begin a word like ``qalv`` or ``lodversion``."""
        for n in range(len(word), 1, -1):
            family = self.alone.get(word[:n])
            rest = word[n:]
            if family is not None and (not rest or (rest in ("v", "ver", "vers", "version") and following and following[0][0].isdigit())):
                return family
        return None

    def mentions(self, tokens: list[str]) -> list[tuple[int, int, int, str]]:
        """(letters, first word, word after, family): the longest non-overlapping ones."""
        text = f" {' '.join(tokens)} "
        starts, at = {}, 0
        for i, t in enumerate(tokens):
            starts[at] = i
            at += len(t) + 1
        found = []
        if len(self.automaton):
            # neighbours share the blank between them, so each is searched with its own
            for end, (length, family) in self.automaton.iter(text):
                first = starts.get(end - length + 1)
                if first is not None:
                    n = text[end - length + 1 : end + 1].count(" ") - 1
                    found.append((length - 1 - n, first, first + n, family))
        for i, t in enumerate(tokens):
            if t[0].isalpha() and (family := self._glued(t, tokens[i + 1 :])):
                found.append((len(t), i, i + 1, family))
        found.sort(key=lambda f: (-f[0], f[1]))
        kept: list[tuple[int, int, int, str]] = []
        for f in found:
            if all(f[2] <= k[1] or f[1] >= k[2] for k in kept):
                kept.append(f)
        return kept

    def _near(self, token: str) -> tuple[tuple[str, int], ...]:
        """The forms' words that a typed word may stand for, with the typing errors."""
        got = self._near_cache.get(token)
        if got is None:
            if len(self._near_cache) > 500_000:
                self._near_cache.clear()
            near, own = [], _letters(token)
            for n in range(max(1, len(token) - MOST_EDITS), len(token) + MOST_EDITS + 1):
                for w, letters in self.by_length.get(n, ()):
                    # one error changes two letters at most
                    m = _allowed(w)
                    if abs(n - len(token)) <= m and (own ^ letters).bit_count() <= 2 * m and (e := _edits(token, w, m)) <= m:
                        near.append((w, e))
            got = tuple(near)
            self._near_cache[token] = got
        return got

    def similar(self, tokens: list[str]) -> tuple[int, int, int, str] | None:
        """The form all of whose words are among the tokens, up to typing errors."""
        near: dict[str, tuple[int, int]] = {}
        for i, t in enumerate(tokens):
            if t[0].isalpha():
                for w, e in self._near(t):
                    near[w] = min(near.get(w, (e, i)), (e, i))
        best_form = None
        for n in {n for w in near for n in self.by_word[w]}:
            form, family = self.forms[n]
            if len(form) < 2 or not all(w in near for w in form):
                continue
            places = [near[w][1] for w in form]
            if len(set(places)) < len(form):
                continue
            edits, size = sum(near[w][0] for w in form), sum(map(len, form))
            score = (size - 2 * edits, -edits, -n)
            if edits * 5 <= size and (best_form is None or score > best_form[0]):
                best_form = (score, size, min(places), max(places) + 1, family)
        return (best_form[0][0], *best_form[2:]) if best_form else None

    def _entry(self, tokens: list[str], mention: tuple[int, int, int, str]) -> str | None:
        """The entry of a mention: by the nearest number, or the only version there is."""
        _, first, after, family = mention
        versions = self.versions[family]
        numbers = [(min(abs(i - first), abs(i - after + 1)), i, t) for i, t in enumerate(tokens) if t[0].isdigit() and len(t.split(".")[0]) < 3]
        if numbers:
            return versions.get(version_key(min(numbers)[2]))
        return next(iter(versions.values())) if len(versions) == 1 else None

    def resolve(self, value: str) -> tuple[int, str] | None:
        """(strength, id), None for no case. Strength 0: nothing found."""
        if value is None or not value.strip() or value.strip().casefold() in self.exact:
            return None
        tokens = words(plain(value))
        found = self.mentions(tokens)
        best = found[0] if found else None
        if best is None or any(len(t) > 3 and t[0].isalpha() and not best[1] <= i < best[2] for i, t in enumerate(tokens)):
            # words are left over: a longer form may lie there with typing errors in it
            best = max((m for m in (best, self.similar(tokens)) if m), key=lambda m: m[0], default=None)
        if best is None:
            return 0, self.unknown
        return best[0], self._entry(tokens, best) or self.unknown


@functools.lru_cache(maxsize=1)
def _matcher(entries: tuple[Entry, ...], unknown: str) -> Matcher:
    return Matcher(entries, unknown)


def _one_shard(entries: tuple[Entry, ...], unknown: str):
    """The rows that need mapping, with the entry."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resolve = functools.lru_cache(maxsize=200_000)(_matcher(entries, unknown).resolve)
        for pdf in batches:
            got = [resolve(v) if isinstance(v, str) else None for v in pdf["value"]]
            pdf = pdf.drop(columns="value").assign(entry_id=[g[1] if g else None for g in got])
            yield pdf[pdf["entry_id"].notna()]

    return run


def _shard_step(entries: tuple[Entry, ...], unknown: str, shard: int):
    """(value, strength, shard, entry_id) by one shard; a value that needs no mapping has the strength -1."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = _matcher(entries, unknown)
        for pdf in batches:
            got = [matcher.resolve(v) or (-1, None) for v in pdf["value"]]
            yield pd.DataFrame({"value": pdf["value"], "strength": [g[0] for g in got], "shard": shard, "entry_id": [g[1] for g in got]})

    return run


def _by_shards(values: DataFrame, shards: Sequence[tuple[Entry, ...]], unknown: str) -> DataFrame:
    """(value, entry_id) of the distinct values that need mapping: by the shard with the longest mention, the first of equal ones."""
    distinct = materialize(values.distinct(), "values")
    out = None
    for i, s in enumerate(shards):
        part = distinct.mapInPandas(_shard_step(s, unknown, i), "value string, strength int, shard int, entry_id string")
        out = part if out is None else out.unionByName(part)
    best = out.groupBy("value").agg(F.min("strength").alias("least"), F.max_by("entry_id", F.struct("strength", -F.col("shard"))).alias("entry_id"))
    return materialize(best.filter("least >= 0").select("value", "entry_id"), "mapped")


def read_entries(df: DataFrame, order: str, id_col: str, name_col: str, aliases_col: str) -> list[Entry]:
    """The canonical list on the driver, at most ``MOST_ENTRIES`` entries."""
    rows = df.orderBy(order).select(id_col, name_col, aliases_col).limit(MOST_ENTRIES + 1).collect()
    if len(rows) > MOST_ENTRIES:
        raise ValueError(f"a list of more than {MOST_ENTRIES} entries is not a canonical list")
    return [Entry(r[0], r[1], tuple(a for a in (r[2] or ()) if a)) for r in rows if r[0]]


def _shards(entries: Sequence[Entry], size: int) -> list[tuple[Entry, ...]]:
    """Whole families together, in the order of the list."""
    families: dict[str, list[Entry]] = {}
    for e in entries:
        families.setdefault(plain(split_version(e.id)[0]), []).append(e)
    shards: list[list[Entry]] = [[]]
    for family in families.values():
        if shards[-1] and len(shards[-1]) + len(family) > size:
            shards.append([])
        shards[-1].extend(family)
    return [tuple(s) for s in shards if s]


def map_values(df: DataFrame, value_col: str, keep: Sequence[str], entries: Sequence[Entry], unknown: str, shard_entries: int = SHARD_ENTRIES) -> DataFrame:
    """The rows of ``df`` whose value needs mapping, with ``entry_id``; ``keep`` columns are carried."""
    shards = _shards(entries, shard_entries) or [()]
    slim = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{value_col}`").alias("value")).filter(F.col("value").isNotNull())
    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    if len(shards) == 1:
        return slim.mapInPandas(_one_shard(shards[0], unknown), f"{fields}, entry_id string")
    mapped = _by_shards(slim.select("value"), shards, unknown)
    return lookup_stored(slim, mapped, "value").select(*[F.col(f"`{c}`") for c in keep], "entry_id")

"""Template residue, filler and error-page text in place of content or beside it.

Values are cut into passages (at bars, dashes, line ends and sentence ends).
Passages that hold an unfilled placeholder or one of the trusted messages are
labelled positives, and so is the list itself. All other passages are
unlabelled: a naive Bayes model over words, neighbouring words and the passage's
ends is fitted by expectation-maximization, in which labelled passages stay
positive and the others get their posterior as weight. Some labelled passages
are hidden among the unlabelled as spies: unlabelled passages that score below
nearly all spies are reliable negatives and stay so, which keeps the two classes
from drifting. A feature speaks for residue once ``SUPPORT`` expected residue
passages hold it, labelled or not. So it learns variants of the messages from
the corpus, and learns from the mass of unlabelled passages that real content
may speak of pages not found, drafts or denied access without being one.

The model alone decides: a value is a case if it holds a passage whose odds
exceed ``ODDS``. Passages are scored whole and by their best run of words,
because a message may stand inside content without a mark between them. A
value's score is the highest of its passages.

The fit uses at most ``TRAIN_VALUES`` values, those with the smallest hash over
the whole table; nothing else reaches the driver. Scoring runs over all values
where they lie, without a shuffle.

Defined cases: null, empty and blank values are no cases; very long values are
read whole; repeated rows stay repeated; an empty table gives no rows; without
any labelled passage in the sample, the model is of the list and the content.
"""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_VALUES = 30_000
ROUNDS = 12
#: one trusted passage in SPY is hidden; all but SPY_SHARE of the hidden ones bound the reliable negatives
SPY, SPY_SHARE = 7, 0.05
#: log odds of a word the sample does not hold: names, mostly, which messages lack
UNSEEN = -1.5
#: a trusted message that makes up this much of its passage makes the whole passage an example
OWN_SHARE = 0.3
#: expected residue passages that must hold a feature before it may speak for residue; each message of the list counts as so many
SUPPORT = 2
#: a message of one or two words has few features to be told by, so the list gives it this many times more
SHORT = 4
#: a feature that content lacks is as rare there as among so many features at least, however small the table is
CONTENT = 100_000
#: smallest share of residue among passages that the prior stands for
LEAST_SHARE = 1e-3
#: log odds a passage needs; a part of a passage needs more
ODDS, PART_ODDS = 4.0, 10.0

_NAME = r"[^\W\d_](?:[\w.-]*\w)?"
#: fixed values: the marks that templating languages put around a name
PLACEHOLDERS = re.compile(
    rf"\{{\{{\s*{_NAME}\s*\}}\}}|[$#]\{{\s*{_NAME}\s*\}}|\{{%-?\s*\w+\s[^%{{}}]*%\}}|<%[=-]?\s*{_NAME}\s*-?%>|(?<![\w{{]){{{_NAME}}}(?![\w}}])"
    rf"|@@{_NAME}@@|\[\[{_NAME}\]\]|(?<!\w)__[^\W\d_](?:[\w.]*?[^\W_])?__(?!\w)|(?<![\w%])%{_NAME}%(?![\w%])|(?<![\w$])\${_NAME}\$(?![\w$])"
    rf"|<(?!/?(?:b|i|u|em|strong|br|p|sup|sub|span|div|a|ul|ol|li|h[1-6]|small|cite|q)\b){_NAME}>|\[\s*insert\s[^\[\]]+\]|\[object \w+\]",
    re.IGNORECASE,
)

#: fixed values: messages that stand in place of content; a 9 stands for any number
TRUSTED = (
    # empty values
    "null", "undefined", "nan", "object object",
    # filler
    "lorem ipsum", "dolor sit amet", "consectetur adipiscing elit", "asdf asdf", "blah blah", "xxxxx xxxxx", "sample text sample text", "text goes here",
    "description goes here", "title goes here", "default title change me", "untitled document", "new page 9", "todo write", "tbd", "text to follow",
    "enter a title for this item", "enter a description", "טקסט לדוגמה", "כאן יבוא תיאור", "beispieltext beispieltext", "texte d exemple", "texto de ejemplo", "пример текста",
    # error pages
    "9 not found", "page not found", "error 9", "http error 9", "internal server error", "an unexpected error occurred", "something went wrong while loading", "went wrong while loading this item",
    "the server is temporarily unavailable", "service unavailable", "gateway timed out", "gateway timeout", "bad gateway", "too many requests", "try again in 9 seconds", "access to this record is denied", "access denied 9",
    "your session has expired", "please sign in again", "database connection failed", "the item could not be loaded", "is down for maintenance", "loading viewer",
    "seite nicht gefunden", "ein fehler ist aufgetreten", "page introuvable", "la page demandée est introuvable", "une erreur est survenue", "página no encontrada", "se ha producido un error",
    "страница не найдена", "произошла ошибка", "доступ запрещён", "הדף המבוקש לא נמצא", "הדף לא נמצא", "אירעה שגיאה", "שגיאה 9", "אין לך הרשאה לצפות",
    # scripts and browser checks
    "enable javascript", "turn on javascript", "javascript is disabled", "javascript is required", "scripts are required", "needs scripts to be switched on in your browser", "allow scripts",
    "your browser does not run scripts", "your browser does not support", "checking your browser", "javascript aktivieren", "aktivieren sie javascript", "activer javascript", "habilite javascript", "active javascript",
    "включите javascript", "להפעיל javascript", "enable cookies",
)

#: one placeholder of each kind of marks
MARKED = ("{{x}}", "${x}", "#{x}", "{% x y %}", "{%- x y %}", "<% x %>", "<%= x %>", "<%- x %>", "{x}", "@@x@@", "[[x]]", "__x__", "%x%", "$x$", "<x>", "[insert x]", "[object x]")

_PASSAGE = re.compile(r"\s+[|–—]\s+|[\r\n]+|(?<=[.!?…])\s+")
_TOKEN = re.compile(r"\d+|[^\W\d_]+")
_PLACE = "⟨placeholder⟩"
#: every placeholder has one of these
_MARK = re.compile(r"[{<\[@$%_]")
_MARKS = re.compile(r"(?:[^\w\s]|_)+")


def tokens(passage: str) -> list[str]:
    """Words in one case, every number as 9; a placeholder gives two words, of which the second names its marks."""
    if not _MARK.search(passage):
        return _words(passage)
    out: list[str] = []
    at = 0
    for m in PLACEHOLDERS.finditer(passage):
        out += _words(passage[at : m.start()])
        out += [_PLACE, f"⟨{_MARKS.match(m[0])[0]}⟩"]
        at = m.end()
    return out + _words(passage[at:])


def _words(text: str) -> list[str]:
    return ["9" if t.isdigit() else t for t in _TOKEN.findall(text.casefold())]


@functools.lru_cache(maxsize=4)
def _messages(trusted: tuple[str, ...]) -> dict[str, list[tuple[str, ...]]]:
    by_first: dict[str, list[tuple[str, ...]]] = {}
    for m in trusted:
        words = tuple(tokens(m))
        by_first.setdefault(words[0], []).append(words)
    return by_first


def trusted_span(passage: str, words: list[str], trusted: tuple[str, ...] = TRUSTED) -> tuple[int, int] | None:
    """The words of a placeholder, of a message of two words or more, or of an empty value's name alone or at the end.

    At the end of other text such a name must be written as programs write it,
    not as a sentence would. Of several messages the longest counts.
    """
    by_first = _messages(trusted)
    found: tuple[int, int] | None = None
    for i, w in enumerate(words):
        if w == _PLACE:
            return i, i + 2
        for m in by_first.get(w, ()):
            if len(m) > 1:
                if tuple(words[i : i + len(m)]) == m and (found is None or len(m) > found[1] - found[0]):
                    found = i, i + len(m)
            elif found is None and len(words) == 1:
                found = 0, 1
            elif found is None and i == len(words) - 1:
                last = _TOKEN.findall(passage)[-1]
                if last.islower() or last.isupper() or last[1:] != last[1:].lower():
                    found = i, i + 1
    return found


def _features(words: Sequence[str]) -> list[str]:
    return [*words, *(f"{a} {b}" for a, b in zip(words, words[1:])), f"^ {words[0]}", f"{words[-1]} $"]


@dataclass(frozen=True)
class Model:
    """Log odds of features, of any other feature, and the prior."""

    odds: dict[str, float]
    other: float
    prior: float

    def score(self, words: Sequence[str]) -> float:
        return self.prior + sum(self.odds.get(f, self.other) for f in _features(words))

    @functools.cached_property
    def telling(self) -> frozenset[str]:
        """The words of the features that speak for residue: a passage without any scores below the prior."""
        return frozenset(w for f, o in self.odds.items() if o > 0 for w in f.split(" "))

    def best(self, words: list[str]) -> float:
        """The odds of the passage or of its best run of words, less what a part needs more.

        Only a run at the passage's start or end has that end's feature. Below
        the prior the number tells nothing and is minus infinity.
        """
        if self.telling.isdisjoint(words) and self.other <= 0:
            return -math.inf
        odds, other, last = self.odds, self.other, len(words) - 1
        top = run = -math.inf
        for i, w in enumerate(words):
            word = odds.get(w, other)
            if i:
                run = word + max(0.0, run + odds.get(f"{words[i - 1]} {w}", other))
            else:
                run = word + odds.get(f"^ {w}", other)
            top = max(top, run + odds.get(f"{w} $", other) if i == last else run)
        return max(self.score(words), top + self.prior - (PART_ODDS - ODDS))


def fit(values: Sequence[str], trusted: tuple[str, ...] = TRUSTED, rounds: int = ROUNDS) -> Model:
    """Expectation-maximization over the passages of the values, with the trusted messages as further labelled passages."""
    index: dict[str, int] = {}
    feats, owner, fixed = [], [], []
    for m in (*trusted, *MARKED):
        w = tokens(m)
        ids = [index.setdefault(f, len(index)) for f in _features(w)]
        for _ in range(SUPPORT * (SHORT if len(w) < 3 else 1)):
            feats += ids
            owner += [len(fixed)] * len(ids)
            fixed.append(True)
    listed = len(fixed)
    for v in values:
        for p in _PASSAGE.split(v):
            w = tokens(p)
            if not w:
                continue
            span = trusted_span(p, w, trusted)
            if span and span[1] - span[0] < OWN_SHARE * len(w):
                # residue inside content: the content around it isn't an example
                w = w[slice(*span)]
            ids = [index.setdefault(f, len(index)) for f in _features(w)]
            feats += ids
            owner += [len(fixed)] * len(ids)
            fixed.append(span is not None)
    certain = np.array(fixed, dtype=bool)
    if len(certain) == listed:
        return Model({}, 0.0, -50.0)
    feats, owner = np.array(feats), np.array(owner)
    size, n = len(index), len(certain)

    def odds_of(weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pos = np.bincount(feats, weights=weight[owner], minlength=size)
        neg = np.bincount(feats, weights=1 - weight[owner], minlength=size)
        absent = 0.1 / (max(neg.sum(), CONTENT) + 0.1 * size)
        odds = np.log((pos + 0.1) / (pos.sum() + 0.1 * size)) - np.log(neg / (neg.sum() + 0.1 * size) + absent)
        # rare content would pass for residue otherwise; expected passages count like trusted ones
        return np.where(pos < SUPPORT, np.minimum(odds, UNSEEN), odds), pos, neg

    def prior_of(weight: np.ndarray) -> float:
        share = min(max(float(weight[listed:].mean()), LEAST_SHARE), 0.5)
        return math.log(share / (1 - share))

    # spies: every SPY-th trusted passage is hidden among the unlabelled; what scores below nearly all spies is negative for good
    spies = certain.copy()
    spies[np.flatnonzero(certain)] = np.arange(certain.sum()) % SPY == 0
    known = certain & ~spies
    if not known.any() or not spies.any():
        known = certain
    odds, _, _ = odds_of(known.astype(float))
    # by feature, so that one strong word does not carry a long passage
    score = np.bincount(owner, weights=odds[feats], minlength=n) / np.bincount(owner, minlength=n)
    least = np.quantile(score[spies if spies.any() else certain], SPY_SHARE)
    negative = ~certain & (score < least)
    weight = certain.astype(float)
    for _ in range(rounds):
        odds, pos, neg = odds_of(weight)
        prior = prior_of(weight)
        score = np.bincount(owner, weights=odds[feats], minlength=n) + prior
        weight = np.where(certain, 1.0, np.where(negative, 0.0, 1 / (1 + np.exp(-np.clip(score, -40, 40)))))
    kept = {f: float(odds[i]) for f, i in index.items() if pos[i] > 0.2 or neg[i] > 0.5}
    return Model(kept, UNSEEN, prior)


def score_value(value: str | None, model: Model, trusted: tuple[str, ...] = TRUSTED) -> tuple[float, str | None]:
    """(odds, passage) of the value's most suspicious passage if labels decide first: labelled ones have infinite odds."""
    top, which = -math.inf, None
    for p in _PASSAGE.split(value or ""):
        words = tokens(p)
        if not words:
            continue
        s = math.inf if trusted_span(p, words, trusted) else model.best(words)
        if s > top:
            top, which = s, p
    return top, which


def model_score(value: str | None, model: Model) -> tuple[float, str | None]:
    """(odds, passage) of the value's most suspicious passage by the model alone."""
    return max(((model.best(tokens(p)), p) for p in _PASSAGE.split(value or "")), key=lambda g: g[0])


def _detect(bc):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Model(*bc.value)
        one = functools.lru_cache(maxsize=50_000)(lambda v: model_score(v, model))
        for pdf in batches:
            got = [one(v) for v in pdf["value"]]
            pdf = pdf.drop(columns="value").assign(odds=[g[0] for g in got], passage=[g[1] for g in got])
            yield pdf[pdf["odds"] > ODDS]

    return run


def find(df: DataFrame, id_col: str, fields: Sequence[str], trusted: tuple[str, ...] = TRUSTED, train_values: int = TRAIN_VALUES) -> DataFrame:
    """(id, field, odds, passage) of every value that is or holds residue."""
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").cast("string").alias("value")) for f in fields])).alias("p")
    values = df.select(F.col(f"`{id_col}`").alias("id"), pairs).select("id", "p.field", "p.value").filter(F.col("value").isNotNull() & (F.col("value") != ""))
    sample = values.orderBy(F.xxhash64("id", "field", "value"), "value").limit(train_values).select("value").toPandas()["value"]
    model = fit(list(sample), trusted)
    bc = df.sparkSession.sparkContext.broadcast((model.odds, model.other, model.prior))  # bounded by the sample
    id_type = df.schema[id_col].dataType.simpleString()
    return values.mapInPandas(_detect(bc), f"id {id_type}, field string, odds double, passage string").withColumnRenamed("id", id_col)

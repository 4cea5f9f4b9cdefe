import random

import numpy as np
import pytest

from ledgerloom.llm import leakage as lk

VOCAB = [f"w{i}" for i in range(400)] + "שלום ספר עולם Straße ÉCOLE".split()


def plain_smith_waterman(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    run = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (lk.MATCH if x == y else lk.MISMATCH), h[i - 1][j] + lk.GAP, h[i][j - 1] + lk.GAP)
            run[i][j] = run[i - 1][j - 1] + 1 if x == y else 0
    return max(map(max, h)), max(map(max, run))


def test_alignment_matches_the_plain_recurrence():
    rng = random.Random(1)
    pairs = [([rng.randrange(6) for _ in range(rng.randrange(1, 40))], [rng.randrange(6) for _ in range(rng.randrange(1, 20))]) for _ in range(60)]
    score, longest = lk.smith_waterman([np.array(a, dtype=np.uint64) for a, _ in pairs], [np.array(b, dtype=np.uint64) for _, b in pairs])
    assert list(zip(score.tolist(), longest.tolist())) == [plain_smith_waterman(a, b) for a, b in pairs]


@pytest.mark.parametrize(
    "text,want",
    [
        ("The <b>old</b> BOOK&nbsp;of_Straße", ["the", "old", "book", "of", "strasse"]),
        ("שָׁלוֹם־עולם", ["שלום", "עולם"]),
        ("a < b > c, 12.5%", ["a", "b", "c", "12", "5"]),
        ("x&#39;y <br/>z", ["x", "y", "z"]),
        ("", []),
    ],
)
def test_words(text, want):
    assert lk.words(text) == want


def brute(docs, items, n):
    out = set()
    for d, t in docs:
        w = lk.words(t or "")
        have = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for e, p in items:
            v = lk.words(p or "")
            if any(tuple(v[k : k + n]) in have for k in range(len(v) - n + 1)):
                out.add((d, e))
    return out


def test_found_is_exact(spark):
    rng = random.Random(2)

    def noise(n):
        return [rng.choice(VOCAB) for _ in range(n)]

    items = [(i, " ".join(noise(rng.randrange(3, 40)))) for i in range(30)] + [(90, None), (91, ""), (92, "one two")]
    items += [(93, " ".join(noise(5) + items[20][1].split()))]
    docs = []
    for d in range(120):
        w = noise(rng.randrange(30))
        for _ in range(rng.randrange(3)):
            v = items[rng.randrange(30)][1].split()
            k = rng.randrange(len(v))
            part = v[k : k + rng.choice([8, 11, 12, 13, 40])]
            if rng.random() < 0.3 and len(part) > 3:
                part[len(part) // 2] = "edited"
            w += [x.upper() + rng.choice(["", ",", "<i>", "&nbsp;", "—"]) for x in part] + noise(rng.randrange(9))
        docs.append((d, " ".join(w)))
    docs += [(500, None), (501, ""), (502, ("pad " * 30_000) + items[0][1]), (502, ("pad " * 30_000) + items[0][1])]
    left = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, words string, at int")
    right = spark.createDataFrame([(i, t, "x") for i, t in items], "eval_id long, text string, gram string")
    aligned = lk.find(left, right, "doc_id", "text", "eval_id", "text").cache()
    got = [tuple(r) for r in lk.leaked(aligned).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, items, 12)
    # an edited copy is no case, but its score tells
    scores = {(r.doc_id, r.eval_id): (r.score, r.longest) for r in aligned.collect()}
    assert any(s >= 20 and n < 12 for s, n in scores.values())
    assert lk.find(left.limit(0), right, "doc_id", "text", "eval_id", "text").count() == 0
    assert lk.find(left, right.limit(0), "doc_id", "text", "eval_id", "text").count() == 0


def test_edited_copies_are_rated(spark):
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice(VOCAB) for _ in range(rng.randrange(25, 60)))) for i in range(40)]
    docs, planted = [], set()
    for d in range(200):
        w = [rng.choice(VOCAB) for _ in range(rng.randrange(10, 60))]
        if d % 2:
            e = rng.randrange(40)
            # one word in six is replaced, dropped or doubled
            part = [y for x in items[e][1].split() for y in (rng.choice([["new"], [], [x, "and"]]) if rng.random() < 1 / 6 else [x])]
            w += part + [rng.choice(VOCAB) for _ in range(20)]
            planted.add((d, e))
        docs.append((d, " ".join(w)))
    left, right = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "eval_id long, text string")
    got = {(r.doc_id, r.eval_id): r.share for r in lk.edited(lk.find(left, right, "doc_id", "text", "eval_id", "text", lk.EDITED_WORDS)).collect()}
    assert len(planted & set(got)) >= 0.9 * len(planted)
    assert set(got) <= planted and all(0 < s <= 1 for s in got.values())


def test_long_windows_in_pieces():
    rng = np.random.default_rng(3)
    item = rng.integers(0, 9, 12).astype(np.uint64)
    doc = rng.integers(0, 9, 5000).astype(np.uint64)
    doc[777:789], doc[3001:3012] = item, item[:11]
    at = np.arange(0, 4988, 10)
    parts = list(lk._windows(doc, item, at, np.zeros(len(at), dtype=np.int64)))
    assert len(parts) > 10 and max(map(len, parts)) <= 4 * (3 * 12 + 2 * lk.MARGIN)
    got = lk.smith_waterman(parts, [item] * len(parts))
    whole = lk.smith_waterman([doc], [item])
    assert (got[0].max(), got[1].max()) == (whole[0][0], whole[1][0]) == (24, 12)


def test_a_seed_in_every_document(spark):
    rng = random.Random(5)
    hot = " ".join(rng.choice(VOCAB) for _ in range(14))
    docs = [(i, hot + " " + " ".join(rng.choice(VOCAB) for _ in range(5))) for i in range(3000)]
    left, right = spark.createDataFrame(docs, "doc_id long, text string").repartition(8), spark.createDataFrame([(1, hot)], "eval_id long, text string")
    aligned = lk.find(left, right, "doc_id", "text", "eval_id", "text")
    assert lk.leaked(aligned).count() == 3000
    assert lk.bitmap_bits(0) == lk.LEAST_BITS and lk.bitmap_bits(10**12) == lk.MOST_BITS

import random

import numpy as np
import pytest

from ledgerloom.llm import repeats as rp

ALPHABET = "abcdefghijklmnopqrstuvwxyz     אבגדה\U0001f4dc"


def noise(rng, n):
    return "".join(rng.choice(ALPHABET) for _ in range(n))


def brute(texts, size):
    """Pairs with a common substring of ``size``, and the characters of each text in a shared one."""
    where = {}
    for i, t in texts:
        for p in range(len(t) - size + 1):
            where.setdefault(t[p : p + size], {}).setdefault(i, []).append(p)
    pairs, cover = set(), {i: set() for i, _ in texts}
    for owners in where.values():
        if len(owners) > 1:
            ids = sorted(owners)
            pairs |= {(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :]}
            for i, ps in owners.items():
                for p in ps:
                    cover[i].update(range(p, p + size))
    return pairs, {i: len(c) for i, c in cover.items()}


def run(spark, texts, size=300):
    df = spark.createDataFrame([(i, t, "clash", 0) for i, t in texts], "doc_id long, text string, key string, rep int")
    classes, spans, wide = rp.shared_spans(df, "doc_id", "text", size)
    got = [(r.doc_a, r.doc_b) for r in rp.pairs(classes, spans).collect()]
    assert len(got) == len(set(got))
    share = {r.id: r.shared_chars for r in rp.shared_share(df, "doc_id", "text", classes, spans, wide, size).collect()}
    return set(got), share


def check(spark, texts, size=300):
    got, share = run(spark, texts, size)
    pairs, cover = brute([(i, t) for i, t in texts if t], size)
    assert got == pairs
    assert share == {i: cover.get(i, 0) for i, _ in texts}


def test_spans_of_every_length_around_the_limit(spark):
    rng = random.Random(1)
    texts = []
    for n, length in enumerate([298, 299, 300, 301, 320, 500, 900]):
        span = noise(rng, length)
        texts += [(10 * n + k, noise(rng, rng.randrange(200)) + "<" + span + ">" + noise(rng, rng.randrange(200))) for k in range(3)]
    texts += [(900, None), (901, ""), (902, "x"), (903, noise(rng, 5000)), (904, texts[3][1]), (905, texts[9][1]), (906, texts[9][1])]
    check(spark, texts)


def test_hot_passages(spark):
    rng = random.Random(2)
    short, long = noise(rng, 200), noise(rng, 340)
    # in more texts than FEW: one passage too short to count, one long enough
    texts = [(i, noise(rng, 150) + str(i) + short + str(i) + noise(rng, 150)) for i in range(40)]
    texts += [(100 + i, noise(rng, 40) + str(i) + long + noise(rng, 40)) for i in range(30)]
    check(spark, texts)


def test_copies_are_one_class(spark):
    rng = random.Random(3)
    t = noise(rng, 400)
    texts = [(i, t) for i in range(50)] + [(60, noise(rng, 100) + t[:320]), (61, noise(rng, 350))]
    check(spark, texts)


def test_long_runs_cut_by_the_ends(spark):
    rng = random.Random(4)
    w = noise(rng, 60)
    texts = [(1, "a" + "-" * 250 + w + "b"), (2, "c" + "-" * 280 + w + "d"), (3, "=-" * 200), (4, "x" + "=-" * 160 + "y"), (5, "-" * 299), (6, "-" * 700)]
    check(spark, texts)


def test_empty_and_repeated_rows(spark):
    rng = random.Random(5)
    t = noise(rng, 400)
    got, share = run(spark, [(1, t), (1, t), (2, noise(rng, 10) + t)])
    assert got == {(1, 2)} and share == {1: 400, 2: 400}
    df = spark.createDataFrame([], "doc_id long, text string")
    classes, spans, _ = rp.shared_spans(df, "doc_id", "text")
    assert rp.pairs(classes, spans).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_equal_substrings_have_common_keys(seed):
    rng = random.Random(seed)
    for _ in range(60):
        span = noise(rng, 300)
        a, b = (rp.code_points(noise(rng, rng.randrange(300)) + span + noise(rng, rng.randrange(300))) for _ in range(2))
        ends = np.array([len(a), len(a) + len(b)])
        names, starts, _ = rp.recompress(np.concatenate([a, b]), ends)
        key, _, text = rp.keys(names, starts, ends)
        assert set(key[text == 0]) & set(key[text == 1])


def test_a_long_text_with_one_run_gives_few_keys():
    import pyarrow as pa

    rng = random.Random(9)
    emit = rp._emit_keys(300)

    def rows(text):
        return sum(b.num_rows for b in emit(iter([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([text])], ["id", "text"])])))

    plain = noise(rng, 100_000)
    assert rows(plain) < 100_000 / 40
    assert rows(plain[:50_000] + " " * 24 + plain[50_000:]) < rows(plain) + 400


@pytest.mark.parametrize("run", [3, 7, 8, 12, 19, 20, 24, 60, 400])
def test_runs_cut_by_the_ends(spark, run):
    rng = random.Random(run)
    texts = []
    for n, mark in enumerate([" ", "-", "ab", "abcabcdf"]):
        long = mark * (run // len(mark) + 1)
        body = noise(rng, 300)
        # what is shared ends inside the run, at either side or at both
        texts += [(10 * n, "x" * 5 + noise(rng, 90) + long + body + long + noise(rng, 90))]
        texts += [(10 * n + 1, noise(rng, 90) + "<" + long[run // 2 :] + body + ">" + noise(rng, 80))]
        texts += [(10 * n + 2, noise(rng, 90) + "[" + body[20:] + long[: run // 2] + "]" + noise(rng, 80))]
    check(spark, texts)


def test_every_common_substring_keeps_a_key():
    rng = random.Random(4)
    for trial in range(400):
        words = [noise(rng, rng.randrange(2, 9)) for _ in range(rng.choice([5, 40, 400]))]
        text = lambda n: " ".join(rng.choice(words) for _ in range(n))[:n]
        body = text(600)[:300]
        pair = [text(rng.randrange(300)) + "☃" + body + "☄" + text(200), (body if trial % 3 == 0 else text(50) + "★" + body + "☆" + text(150))]
        got = []
        for t in pair:
            p, ends = rp.code_points(t), np.array([len(t)])
            names, starts, _ = rp.recompress(p, ends)
            key, pos, owner = rp.keys(names, starts, ends)
            at = rp.kept(key, owner)
            first = t.index(body)
            got.append({(int(k), int(x) - first) for k, x in zip(key[at], pos[at]) if 0 <= x - first <= 300 - rp.KEY})
        assert got[0] & got[1], trial


def test_pairs_of_big_classes_are_the_same(spark):
    rng = random.Random(6)
    shared = noise(rng, 320)
    texts = [(i, "copy " + shared) for i in range(9)] + [(20 + i, "other " + shared + " end") for i in range(7)] + [(40, shared + noise(rng, 50)), (41, noise(rng, 400)), (42, noise(rng, 30))]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    classes, spans, _ = rp.shared_spans(df, "doc_id", "text", 300)
    want, _ = brute(texts, 300)
    for big, salts in ((500, 32), (3, 4), (1, 7)):
        got = [(r.doc_a, r.doc_b) for r in rp.pairs(classes, spans, big, salts).collect()]
        assert len(got) == len(set(got)) and set(got) == want

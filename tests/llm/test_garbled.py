import random
from collections import Counter

import pytest

from ledgerloom.llm import garbled as g

HEBREW = "לא נמכר כאן מכתב הקונה העשיר מכיל דפים תיבה צפוף ואופה שהיה שנתי כתב יד בית הגנזים שימוש מותר למחקר בלבד ולאחר מכן הועתק בשנת אצל".split()
RUSSIAN = "на листе виден светлый подпись переплёт позже продан затем возвращён старый рукопись запись был переведён школа тайно сшит не из году".split()
LATIN = "größtenteils geprüft während gewöhnliche Händler Öffentlich zugänglich für Mühlen près légende daté réparé déjà forêt pequeño señor último más año page seal of the".split()


@pytest.fixture(scope="module")
def words():
    return Counter({w: 30 for w in HEBREW + RUSSIAN + LATIN if not w.isascii()})


@pytest.fixture(scope="module")
def model(words):
    return g.train(words)


@pytest.mark.parametrize("chain", [c for c in g.CHAINS if c[0][0] == "utf-8"], ids=g.name)
def test_utf8_chains_are_found_and_undone(model, chain):
    for w in HEBREW[:6] + RUSSIAN[:6] + LATIN[:6]:
        bad = g.garble(w, chain)
        if w.isascii() or bad in (None, w):
            continue
        found = g.diagnose(bad, model)
        assert found is not None, (w, bad)
        assert found[1] == w, (w, bad, found)


def test_single_byte_chains(model):
    for right, wrong, sample in [("cp1255", "cp1252", HEBREW), ("cp1255", "cp1251", HEBREW), ("koi8-r", "cp1251", RUSSIAN), ("cp1251", "cp1252", RUSSIAN), ("cp1252", "mac_roman", LATIN), ("cp1252", "cp1255", LATIN)]:
        chain = ((right, wrong),)
        long = [w for w in sample if len(w) > 4 and not w.isascii() and "ё" not in w and g.garble(w, chain) != w]
        undone = [g.diagnose(g.garble(w, chain), model) for w in long]
        assert all(undone), (chain, [w for w, u in zip(long, undone) if not u])
        assert sum(u[1] == w for w, u in zip(long, undone)) >= 0.8 * len(long), chain


def test_clean_text_is_left_alone(model):
    for w in HEBREW + RUSSIAN + LATIN + ["×", "–", "£68", "¤", "©", "Þing", "ÂGE", "כ״י", "НЕ", "SÃO"]:
        assert g.diagnose(w, model) is None, w


def test_lost_bytes(model):
    for w in ["r�cent", "×�×ª×�", "×¨×™×©×§××”", "Archiveâ€", "Free\x96use"]:
        assert g.diagnose(w, model) is not None, w


def test_lone_signs_and_lost_bytes():
    words = Counter({"×": 900, "–": 500, "à": 400, "¤": 9, "±": 9, "für": 60, "Über": 80, "Straße": 40, "שלום": 30, "של": 90})
    model = g.train(words)
    for w, want in [("◊", "×"), ("ª", "×"), ("╫", "×"), ("Ã\x97", "×")]:
        assert g.diagnose(w, model)[1] == want, w
    for w in ["Ãber", "StraÃe", "×©×"]:
        assert g.diagnose(w, model) == (None, None), w
    for w in ["¤", "±", "à", "×", "é"]:
        assert g.diagnose(w, model) is None, w


def test_frame(spark):
    rng = random.Random(2)
    lines = [" ".join(rng.choice(s) for _ in range(9)) for s in (HEBREW, RUSSIAN, LATIN) for _ in range(30)]
    rows = [(i, t, None, "clash") for i, t in enumerate(lines)]
    whole = g.garble(lines[0], (("utf-8", "cp1252"),))
    part = lines[70] + " " + g.garble("größtenteils", (("utf-8", "cp1251"),))
    rows += [(100, whole, "", "x"), (101, "ascii only", part, "x"), (101, "ascii only", part, "x"), (102, "", None, "x"), (103, "ab " * 30_000 + "r�cent", None, "x"), (None, whole, None, "x")]
    df = spark.createDataFrame(rows, "page_id long, title string, description string, value string")
    got = sorted((tuple(r) for r in g.find(df, "page_id", ["title", "description"]).collect()), key=str)
    want = [(100, "title", "utf-8 read as cp1252", lines[0]), (None, "title", "utf-8 read as cp1252", lines[0])]
    want += [(101, "description", "utf-8 read as cp1251", lines[70] + " größtenteils")] * 2 + [(103, "title", None, None)]
    assert got == sorted(want, key=str)
    assert g.find(df.limit(0), "page_id", ["title"]).count() == 0


def test_counts_are_of_all_values(spark, model):
    # the model's sample holds neither word
    df = spark.createDataFrame([("Über dem",)] * 5 + [("Ãber dem",)], "value string")
    bc = spark.sparkContext.broadcast(model.weights)
    assert [(r.word, r.chain, r.text) for r in g.diagnoses(df, bc).collect()] == [("Ãber", -1, None)]
    assert g.diagnose("Ãber", model) is None


def test_the_classifier_decides_first(model):
    # with a classifier that prefers "clean" everywhere nothing is found, strict UTF-8 or not
    blind = g.Model(model.weights.copy(), model.counts)
    blind.weights[:, : len(g.SCRIPTS)] = 0
    for word, chain in [("größtenteils", (("utf-8", "cp1252"),)), ("הגנזים", (("cp1255", "cp1251"),))]:
        bad = g.garble(word, chain)
        assert g.diagnose(bad, model)[1] == word
        assert g.diagnose(bad, blind) is None


def test_the_fit_does_not_depend_on_the_size_of_the_corpus(words):
    # garbled words that grow with the corpus do not pass for right ones
    bad = [g.garble(w, (("cp1255", "cp1251"),)) for w in HEBREW if len(w) > 3]
    for times in (1, 100):
        grown = Counter({w: 3_000 * times * n for w, n in words.items()})
        grown.update({w: times for w in bad})
        model = g.train(grown)
        assert all(g.diagnose(w, model) is not None for w in bad)
        assert [w for w in words if g.diagnose(w, model) is not None] == []


def test_a_very_long_word(model):
    import time

    clean, rest = "שלום" * 50_000, "größtenteils" * 20_000
    began = time.time()
    assert g.diagnose(clean, model) is None
    for bad, want in [(g.garble(clean, (("utf-8", "cp1252"),)), clean), (g.garble(rest, (("utf-8", "latin-1"),)), rest), (g.garble(clean, (("cp1255", "cp1251"),)), clean)]:
        assert g.diagnose(bad, model)[1] == want
    assert g.diagnose(g.garble(rest, (("utf-8", "cp1252"),)) + "Ã", model) is not None
    assert time.time() - began < 60

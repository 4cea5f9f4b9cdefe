import math
import random

import pytest

from ledgerloom.llm import residue as r

NOTHING = r.Model({}, 0.0, -50.0)

CASES = [
    "{{title}}", "a {{ item_id }} b", "${name}", "#{a.b}", "{% block title %}", "<%= page.summary %>", "@@כותרת@@", "[[desc]]", "__title__", "%name%", "$desc$", "<item.title>", "[insert name]",
    "null", "Some archive | undefined", "end of text. NaN", "Box 7 null", "404 Not Found", "Lorem ipsum dolor", "Please enable JavaScript to view this page.", "PAGE NOT FOUND", "הדף המבוקש לא נמצא", "Страница не найдена",
]
CONTENT = [
    "Null and void: cancelled deed", "[[?]] on leaf 3, reading uncertain", "Shelf label __ A_7 __ of the binder", "[Letter of Tovmar, undated]", "45% linen, price in $ and %", "The page was not found in the binding",
    "Folder 404, leaves not found in the older list", "curly braces { } join the columns", "<i>italic</i> text", "Untitled poem by Halmar", "access is denied to the widow", "", " ",
]


@pytest.mark.parametrize("value", CASES)
def test_trusted(value):
    assert r.score_value(value, NOTHING)[0] == math.inf


@pytest.mark.parametrize("value", CONTENT)
def test_content(value):
    assert r.score_value(value, NOTHING)[0] < r.ODDS


def corpus():
    rng = random.Random(4)
    nouns, adjectives = "ledger oath page binding receipt river letter council widow box".split(), "torn faded narrow public older broad".split()
    real = [f"The {rng.choice(adjectives)} {rng.choice(nouns)} of the {rng.choice(nouns)} was found in the {rng.choice(nouns)} and is missing" for _ in range(600)]
    real += ["The page was not found in the binding and is missing"] * 20
    trusted = ["Error 404: the item could not be loaded", "Please enable JavaScript to view this item", "Something went wrong while loading this item", "Page not found", "Your session has expired, please sign in again"] * 12
    return real, trusted


def test_variants_are_learned_and_content_is_not():
    real, trusted = corpus()
    unseen = ["the item could not be loaded, please sign in again"] * 5
    model = r.fit(real + trusted + unseen)
    assert r.score_value(unseen[0].split(", please")[0].replace("item", "record") + " please sign in", model)[0] > r.ODDS
    flagged = [v for v in real if r.score_value(v, model)[0] > r.ODDS]
    assert not flagged


def test_frame(spark):
    real, trusted = corpus()
    rows = [(i, v, None, "x") for i, v in enumerate(real)] + [(10_000 + i, v, "", "x") for i, v in enumerate(trusted)]
    rows += [(20_000, real[0], "word " * 30_000 + "{{title}}", "x")] * 2 + [(None, "null", None, "x")]
    df = spark.createDataFrame(rows, "page_id long, title string, description string, value string")
    got = sorted(((x.page_id, x.field) for x in r.find(df, "page_id", ["title", "description"]).collect()), key=str)
    want = [(10_000 + i, "title") for i in range(len(trusted))] + [(20_000, "description")] * 2 + [(None, "title")]
    assert got == sorted(want, key=str)
    assert r.find(df.limit(0), "page_id", ["title"]).count() == 0


def test_em_raises_words_that_no_label_holds(spark):
    real, trusted = corpus()
    model = r.fit(real + trusted + ["this item could not be loaded, kindly reconnect soon"] * 8)
    assert model.odds["kindly"] > 0
    rows = [(i, v) for i, v in enumerate(real + trusted + ["this item could not be loaded, kindly reconnect soon"] * 8 + ["kindly reconnect soon"])]
    got = {x.page_id for x in r.find(spark.createDataFrame(rows, "page_id long, title string"), "page_id", ["title"]).collect()}
    assert got == set(range(len(real), len(rows)))


def test_the_model_decides_listed_messages_too():
    real, trusted = corpus()
    for model in (r.fit(real + trusted), r.fit(real), r.fit(["null"])):
        assert [v for v in CASES if r.model_score(v, model)[0] <= r.ODDS] == []
        assert all(math.isfinite(r.model_score(v, model)[0]) for v in CASES)
    assert [v for v in real if r.model_score(v, r.fit(real + trusted))[0] > r.ODDS] == []

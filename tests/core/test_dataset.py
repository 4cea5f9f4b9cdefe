import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import paths
from ledgerloom.functions import text as tx
from ledgerloom.operators import classify, decisions, dedupe, holdout, nested, releases, rights, splits, validation


def one(spark, col, value, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(col.alias("r")).first().r


@pytest.mark.parametrize(
    "text,template,allowed,want",
    [
        ("x", "handwritten_note", None, ("handwritten", 0.95, None)),
        ("A Note of hand", "", ["printed"], ("handwritten", 0.85, None)),
        ('דו"ח שנתי', None, None, ("printed", 0.8, None)),
        ("x", "", ["handwritten_letter", "printed"], ("mixed", 0.5, "content_conflicting_source_priors")),
        ("x", "", ["manuscript"], ("handwritten", 0.7, None)),
        ("x", "", [], ("mixed", 0.45, "content_unknown")),
        (None, None, None, ("mixed", 0.45, "content_unknown")),
    ],
)
def test_content_class(spark, text, template, allowed, want):
    df = spark.createDataFrame([(text, template, allowed)], "t string, k string, a array<string>")
    assert tuple(df.select(classify.content_class(F.col("t"), F.col("k"), F.col("a")).alias("c")).first().c) == want


def test_period_language_and_quality(spark):
    no = F.lit(False)
    assert one(spark, classify.period_class(F.col("v"), F.lit(None).cast("string"), no, no, no), "in 1941").value == "modern"
    assert one(spark, classify.period_class(F.col("v"), F.lit("Historical"), no, no, no), "in 1941").confidence == 0.95
    assert [one(spark, classify.language_class(F.col("v"), no), t).value for t in ("שלום", "שלום a", "a", "5", None)] == ["hebrew_only", "mixed_language", "mixed_language", "hebrew_only", "hebrew_only"]
    schema = "v array<struct<width: int, height: int>>"
    for assets, made, want in [([], False, (0.5, "low")), (None, True, (0.6, "medium")), ([(800, 1000)], False, (0.9, "high")), ([(800, 1000), (798, 1000)], True, (0.85, "high")), ([(None, 2000)], None, (0.75, "medium"))]:
        assert tuple(one(spark, classify.quality(F.col("v"), F.lit(made).cast("boolean")), assets, schema)) == want


def test_rights_by_alias_then_strategy(spark):
    licences = spark.createDataFrame([(1, "A-1", ["a one", None], "open"), (2, "A-2", ["a one"], "shut"), (9, "UNKNOWN", None, "review")], "ord int, id string, aliases array<string>, class string")
    strategies = spark.createDataFrame([("e", "exact_match", ["Free"], "A-1", "open"), ("c", "contains", ["free"], "A-2", "shut"), ("m", "manual_review", [], "A-2", "shut")], "source string, type string, values array<string>, license_id string, license_class string")
    rows = [(" A ONE ", "m"), ("a-2", "x"), ("free", "e"), ("so free", "e"), ("so FREE", "c"), ("", "c"), (None, "m"), ("zzz", None), ("UNKNOWN", "x")]
    got = rights.normalise(spark.createDataFrame(rows, "t string, s string"), "t", "s", licences, strategies).collect()
    assert {(r.t, r.s): (r.license_id, r.matched_by) for r in got} == dict(
        zip(rows, [("A-1", "alias"), ("A-2", "alias"), ("A-1", "exact"), ("UNKNOWN", "unknown"), ("A-2", "contains"), ("UNKNOWN", "unknown"), ("A-2", "manual"), ("UNKNOWN", "unknown"), ("UNKNOWN", "alias")])
    )


def test_decisions(spark):
    items = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, q string")
    side = lambda rows: spark.createDataFrame(rows, "k string, outcome string, detail string")
    merged = decisions.merge(items, "k", [("manual", side([("a", "approve", "x"), ("z", "reject", None)])), ("allow", side([("a", "ready", "y"), ("b", None, None)]))], ("default", "open"))
    assert {r.k: (r.decision_source, r.outcome, r.detail) for r in merged.collect()} == {"a": ("manual", "approve", "x"), "b": ("allow", None, None), "c": ("default", "open", None)}
    bad = decisions.unknown_targets(spark.createDataFrame([("a", "1"), ("a", None), ("a", "2"), ("y", "1"), ("y", None), ("y", "9")], "k string, q string"), items, "k", "q")
    assert {(r.k, r.q): r.reason for r in bad.collect()} == {("a", "2"): "mismatch", ("y", "1"): "other_item", ("y", None): "unknown_item", ("y", "9"): "unknown_item"}
    frames = {"allow": items, "block": items.filter("k = 'a'"), "manual": items.limit(0)}
    assert [(r.k, r.frames) for r in decisions.overlaps(frames, "k").collect()] == [("a", "allow,block")]
    marks = spark.createDataFrame([("a", "me"), ("a", "me"), ("b", "you")], "k string, who string")
    assert {r.k: r.decided for r in decisions.own(items, marks, "k", "who", "me").collect()} == {"a": True, "b": False, "c": False}
    assert [tuple(r) for r in decisions.progress(items.withColumn("g", F.lit(1)), marks, "k", "g").collect()] == [(1, 3, 2, 1)]


def test_holdout_resolutions(spark):
    rows = [("g1", 1), ("g1", 2), ("g2", 1), ("g2", 3), ("g3", 4), ("g3", 5), ("g4", 2), ("g4", 6), ("g5", 1), (None, 1)]
    grouped = holdout.members(spark.createDataFrame([(g, i) for g, i in rows], "work string, id int"), "id", ["work"])
    held = lambda *ids: spark.createDataFrame([(i,) for i in ids], "item int")
    got = holdout.resolve(holdout.risks(grouped, held(1, 2)), holdout.risks(grouped, held(1, 4)))
    # g1: both held out now; g2 as accepted; g3 no risk any more; g4 new
    assert {r.group_id: (r.held_out, r.others, r.status) for r in got.collect()} == {"g1": (0, 0, "unused"), "g2": (1, 1, "accepted"), "g3": (0, 0, "unused"), "g4": (1, 1, "unresolved")}
    stale = holdout.resolve(holdout.risks(grouped, held(1)), holdout.risks(grouped.filter("item <> 3").unionByName(held(7).select(F.lit("work").alias("kind"), F.lit("g2").alias("group_id"), "item")), held(1)))
    assert {r.group_id: r.status for r in stale.collect()} == {"g1": "accepted", "g2": "stale"}


def test_baselines_and_counts(spark):
    t = dt.datetime(2024, 1, 1)
    versions = spark.createDataFrame([("v9", t), ("v10", t), ("v11", None), ("v2", t - dt.timedelta(1))], "v string, at timestamp")
    pick = lambda df, cur=None: [r.v for r in releases.latest_baseline(df, "v", "at", cur).collect()]
    assert (pick(versions), pick(versions, "v10"), pick(versions.filter("v = 'v11'")), pick(versions.limit(0))) == (["v10"], ["v9"], ["v11"], [])
    side = lambda rows: spark.createDataFrame(rows, "k string, n long")
    got = releases.count_mismatches(side([("a", 1), ("b", 2)]), side([("b", 3), ("a", 1), ("c", 4)]), ["k"])
    assert sorted(tuple(r) for r in got.collect()) == [("b", 2, 3), ("c", 0, 4)]
    rows = spark.createDataFrame([(i, i % 3 == 0) for i in range(30)], "i int, made boolean")
    top = releases.balanced_top(rows, "made", [F.col("i")], 2, 100).collect()
    assert sorted(r.i for r in top) == [0, 1, 2, 3, 6, 9]
    with pytest.raises(ValueError):
        releases.balanced_top(rows, "made", [F.col("i")], -1, 1)
    stamps = {"2024-01-02T03:04:05Z": dt.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05": dt.datetime(2024, 1, 2, 3, 4, 5), "2024-01-02T03:04:05.5+02:00": dt.datetime(2024, 1, 2, 1, 4, 5, 500000), "no": None, None: None}
    for text, want in stamps.items():
        assert one(spark, F.date_format(releases.instant(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSSSSS"), text) == (want and want.strftime("%Y-%m-%d %H:%M:%S.%f"))
    listed = releases.ordered(spark.createDataFrame([("b", "test"), ("a", None), ("c", "train"), ("a", "test")], "i string, split string"), "split", ["i"])
    assert [(r.i, r.split) for r in listed.orderBy("place").collect()] == [("c", "train"), ("a", "test"), ("b", "test"), ("a", None)]


def test_versioning(spark):
    schema = "r string, v int, why string, old string"
    then = spark.createDataFrame([("a", 1, None, None), ("b", 1, None, None), ("c", 1, None, None), ("d", 1, None, None), ("e", 1, "w", None)], schema)
    now = spark.createDataFrame([("a", 1, "said", None), ("b", 2, "said", None), ("c", 2, " ", None), ("f", 1, None, "d")], schema)
    got = releases.versioning(then, now, "r", ["why"], ["old"], "why")
    assert {r.r: r.event for r in got.collect()} == {"b": "changed", "c": "changed_without_reason", "d": "replaced", "e": "disappeared", "f": "added"}


def test_split_precedence_and_signatures(spark):
    docs = spark.createDataFrame([(1, "f", "i"), (2, "f", None), (3, "g", "i"), (4, None, ""), (5, "h", "j")], "d int, f string, i string")
    got = {r.d: (r.split_group, r.group_kind) for r in splits.group_by_precedence(docs, "f", "i", F.concat(F.lit("own:"), F.col("d"))).collect()}
    assert got == {1: ("cluster:f", "cluster"), 2: ("cluster:f", "cluster"), 3: ("group:i", "group"), 4: ("own:4", "own"), 5: ("own:5", "own")}
    schema = "v array<struct<hash: string, preview_hash: string>>"
    for assets, want in [([("a", "x"), (None, "y")], "a|y"), ([("a", None), (None, None)], None), ([], None), (None, None)]:
        assert one(spark, dedupe.item_signature(F.col("v")), assets, schema) == want


def test_nested_members_and_checks(spark):
    df = spark.createDataFrame([(1, [("a", 1), ("x", 2), ("b", 3)]), (2, None), (3, [("x", 1), (None, 2)])], "k int, m array<struct<id: string, n: int>>")
    known = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    assert {r.k: [tuple(m) for m in r.m] for r in nested.keep_members(df, "k", "m", "id", known, "id").collect()} == {1: [("a", 1), ("b", 3)], 2: [], 3: []}
    rows = spark.createDataFrame([(1, "a", "a"), (2, None, None), (3, "a", None)], "k int, x string, y string")
    assert [tuple(r) for r in validation.unequal(rows, ["k"], {"xy": (F.col("x"), F.col("y"))}).collect()] == [(3, "xy")]
    assert validation.bad_shares({"a": 0.8, "b": 0.1, "c": 0.1}) == [] and len(validation.bad_shares({"a": -0.5, "b": 1.4})) == 2


def test_paths(spark):
    cases = {"a/b.jpg": "mbi", "": "", "/a": "", "a/../b": "", "..": "", " a": "b", "a:b": "", "1:b": "m", ".work/a": "bi", "~a": "mb", "a\\b": "", "http://x": "", "a//b": "mbi", "./a": "mbi", ".": ""}
    df = spark.createDataFrame([(p,) for p in cases], "p string").select("p", *[paths.is_portable(F.col("p"), **kw).alias(n[0]) for n, kw in paths.VARIANTS.items()])
    got = {r.p: "".join(k for k in "mbi" if r[k]) for r in df.collect()}
    assert got == cases | {"1:b": "mi"}
    schema = "v struct<a: string, l: array<string>, s: array<struct<p: string>>, m: map<string,string>>"
    value = ("/x", ["/x", "y", None], [("file:///q",), ("package://q",)], {"a": "C:\\x", "b": "c"})
    dtype = spark.createDataFrame([], schema).schema["v"].dataType
    got = one(spark, paths.without_local(F.col("v"), dtype), value, schema)
    assert (got.a, got.l, [x.p for x in got.s], got.m) == (None, ["y", None], [None, "package://q"], {"b": "c"})
    for url, kind, want in [("http://h/a.JPG?x=1.png", None, "jpg"), ("http://h/a", "image/png; q=1", "png"), ("http://h/a.exe", "text/html", None), (None, None, None)]:
        r = spark.createDataFrame([(url, kind)], "u string, k string").select(paths.extension(F.col("u"), F.col("k")).alias("e")).first()
        assert r.e == want
    assert one(spark, paths.full_image(F.col("v"), "Servlet", "f=thumbnail", "f=stream"), "x/Servlet?f=thumbnail") == "x/Servlet?f=stream"
    assert [one(spark, paths.same_page(F.col("v"), F.lit("http://a/b/")), v) for v in ("http://a/b", "http://a/b?x", "http://a/bc", "", None)] == [True, True, False, False, False]
    assert str(paths.resolve("package://x/y", package="/p")) == "/p/x/y" and str(paths.resolve("/a")) == "/a" and str(paths.resolve("b", root="/r/s")) == "/r/s/b"
    with pytest.raises(ValueError):
        paths.resolve("b")


def test_text(spark):
    assert one(spark, tx.casefold(F.col("v")), "STRAßE ΣΑΣ") == "strasse σασ"
    assert one(spark, tx.holds_any(F.col("v"), ["CAPTCHA"]), "a captcha") is True and one(spark, tx.holds_any(F.col("v"), ["x"]), None) is False
    assert [one(spark, tx.is_nfc(F.col("v")), t) for t in ("é", "e\u0301", "", None)] == [True, False, True, None]


def test_targets_batches_and_sets(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 9), ("z", 1)], "s string, n long")
    targets = spark.createDataFrame([("a", 5), ("b", 5), ("c", 5)], "s string, target long")
    assert {r.s: (r.n, r.gap, r.status) for r in releases.against_targets(counts, targets, "s").collect()} == {"a": (3, 2, "short"), "b": (9, 0, "met"), "c": (0, 5, "missing")}
    batches = spark.createDataFrame([("x", True, "2024-01-01"), ("y", False, None)], "batch_id string, active boolean, opened_at string")
    opened = decisions.open_batch(decisions.open_batch(batches, "z", "2024-02-01"), "y", "2024-03-01")
    assert {r.batch_id: r.active for r in opened.collect()} == {"x": False, "y": True, "z": False}
    items = spark.createDataFrame([("y", "b"), ("x", "a"), ("y", "a")], "batch_id string, id string")
    assert sorted((r.id, r.place) for r in decisions.items_of_active(opened, items, "id").collect()) == [("a", 0), ("b", 1)]
    left, right = spark.createDataFrame([(1, None), (1, "a"), (None, None)], "x int, y string"), spark.createDataFrame([(1, None), (1, None)], "x int, y string")
    assert sorted((tuple(r) for r in validation.unknown_rows(left, right, ["x", "y"]).collect()), key=str) == [(1, "a"), (None, None)]
    assert validation.set_problems(["a", "b"], ["b", "c", "c"]) == ["missing a", "unexpected c"] and validation.set_problems(["a"], ["a", "b"], exact=False) == []
    assert [one(spark, releases.has_zone(F.col("v")), v) for v in ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00+02:00", "2024-01-01T00:00:00", "2024-01-01", None)] == [True, True, False, False, False]
    assert [one(spark, releases.expired(F.col("v"), F.lit("2024-06-01")), v) for v in ("2024-05-31", "2024-06-01", None)] == [True, False, False]
    df = spark.createDataFrame([(1, "a", "b"), (2, "a", None), (3, "x", "a")], "i int, p string, q string")
    got = releases.restrict({"d": (df, ["p", "q"]), "e": (df, ["p"])}, spark.createDataFrame([("a",), ("b",), (None,)], "k string"), "k")
    assert [sorted(r.i for r in got[n].collect()) for n in "de"] == [[1], [1, 2]]


def test_rights_texts(spark):
    phrases = ["Any Use Permitted", "Copyright"]
    assert [one(spark, rights.statement_in(F.col("v"), phrases), v) for v in ("<b>any use permitted</b> copyright", "COPYRIGHT", "none", None)] == ["any use permitted", "COPYRIGHT", None, None]
    assert [one(spark, rights.standard_form(F.col("v"), "Free", ["public domain"]), v) for v in (" In the Public Domain ", " mine ", " ", None)] == ["Free", "mine", None, None]

import datetime as dt
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx
from ledgerloom.operators import aggregates, dedupe, evaluation, history, joins, rules, skew, splits, validation

T0 = dt.datetime(2024, 1, 1)


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    "expr,value,want",
    [
        (tx.strip, "\u3000 a\u00a0", "a"),
        (tx.fold, " \tÉCOLE\u2003", "école"),
        (tx.first_line, " one \r\ntwo", "one"),
        (tx.natural_key, "V0.10", "v" + "0" * 20 + "." + "10".rjust(20, "0")),
        (tx.escape_html, "<a b='c'>&\"", "&lt;a b=&#39;c&#39;&gt;&amp;&quot;"),
        (tx.safe_name, "a b/c:é.txt", "a_b_c__.txt"),
        (tx.url_host, "HTTPS://Ex.Org/a", "ex.org"),
        (tx.url_path, "https://x.org/a%20b+c", "/a b+c"),
        (tx.url_path, "not a url", None),
        (tx.url_extension, "https://x.org/a.JPG?x=1.png", "jpg"),
        (tx.is_portable_path, "a/b.txt", True),
        (tx.is_portable_path, "../b", False),
        (tx.is_portable_path, "C:\\x", False),
        (tx.is_portable_path, "", False),
        (tx.is_portable_path, None, False),
        (tx.looks_local, "/home/x", True),
        (tx.looks_local, "data/x", False),
        (tx.script_class, "abc שלום", "mixed"),
        (tx.script_class, None, "other"),
    ],
)
def test_text(spark, expr, value, want):
    assert one(spark, value, expr) == want


def test_bucket_and_split(spark):
    for v in ("a", "item:7", "שלום"):
        want = int(hashlib.sha256(v.encode()).hexdigest()[:13], 16) / 2**52
        assert one(spark, v, tx.stable_bucket) == want
        name = "train" if want < 0.8 else "validation" if want < 0.9 else "test"
        assert one(spark, v, lambda c: splits.pick_split(c, [("train", 0.8), ("validation", 0.1), ("test", 0.1)])) == name


def test_split_leakage(spark):
    df = spark.createDataFrame([("a", "w", "train"), ("a", "x", "test"), ("b", "w", "train"), (None, "y", "test"), (None, "y", None)], "g string, h string, split string")
    assert {tuple(r) for r in splits.leakage(df, ["g", "h"], "split").collect()} == {("g", "a", "test,train", 2)}


def test_dedupe(spark):
    df = spark.createDataFrame([(3, "f", "s1"), (1, "f", "s2"), (2, "g", "s1"), (5, "f", "s1")], "id long, fp string, source string").withColumn("prio", dedupe.priority(F.col("source"), ["s1"]))
    marked = dedupe.canonical_rows(df, "fp", "id", ["prio"])
    assert {(r.id, r.cluster_size) for r in marked.filter("is_canonical").collect()} == {(3, 3), (2, 1)}
    assert [tuple(r) for r in dedupe.clusters(df, "fp", "id", ["prio"]).collect()] == [("f", 3, 3)]
    near = spark.createDataFrame([("s", "a"), ("s", "a"), ("s", "b"), ("t", "c"), ("t", "c"), (None, "d"), (None, "e")], "sig string, fp string")
    assert [tuple(r) for r in dedupe.near_clusters(near, "sig", "fp").collect()] == [("s", 3, 2)]


def test_lookup_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [("hot" if i % 3 == 0 else f"k{rng.randrange(900)}", i) for i in range(9000)] + [(None, -1)]
    left = spark.createDataFrame(rows, "k string, i long")
    right = spark.createDataFrame([("hot", "H")] + [(f"k{j}", f"v{j}") for j in range(0, 900, 2)], "k string, v string")
    assert [r.k for r in skew.hot_keys(left, "k", 9001, hot_rows=100).collect()] == ["hot"]
    table = dict((r.k, r.v) for r in right.collect())
    for hot_rows in (100, 1_000_000):
        got = sorted((r.i, r.v) for r in skew.lookup(left, right, "k", hot_rows=hot_rows).collect())
        assert got == sorted((i, table[k]) for k, i in rows if k in table)
        got = sorted(((r.i, r.v) for r in skew.lookup(left, right, "k", how="left", hot_rows=hot_rows).collect()), key=str)
        assert got == sorted(((i, table.get(k)) for k, i in rows), key=str)


def test_joins(spark):
    facts = spark.createDataFrame([("a", 5), ("a", 1), ("b", 9), ("c", 2), (None, 3)], "k string, t long")
    states = spark.createDataFrame([("a", 2, "x"), ("a", 5, "y"), ("b", 10, "z"), ("c", 1, None)], "k string, s long, v string")
    got = {(r.k, r.t): r.v for r in joins.range_lookup(facts, "k", "t", states, "s", ["v"]).collect()}
    assert got == {("a", 5): "y", ("a", 1): None, ("b", 9): None, ("c", 2): None, (None, 3): None}
    dim = spark.createDataFrame([(2, "B", ["x", "y"]), (1, "A", ["x"]), (3, "C", None)], "ord int, id string, labels array<string>")
    df = spark.createDataFrame([("x",), ("y",), ("q",), (None,)], "v string")
    assert {r.v: r.id for r in joins.first_match(df, F.col("v"), dim, F.col("labels"), "ord", "id").collect()} == {"x": "A", "y": "B", "q": None, None: None}
    left = spark.createDataFrame([("i1", "r9"), ("i9", "r2"), ("i9", "r9"), (None, "r1")], "i string, r string")
    right = spark.createDataFrame([("i1", "r1", "Q1"), ("i2", "r2", "Q2")], "ri string, rr string, q string")
    assert sorted(((x.i, x.r, x.q) for x in joins.either_key(left, right, [("i", "ri"), ("r", "rr")], "q").collect()), key=str) == sorted([("i1", "r9", "Q1"), ("i9", "r2", "Q2"), ("i9", "r9", None), (None, "r1", "Q1")], key=str)
    ok, lost = joins.required(facts, states, ["k"])
    assert ok.count() == 6 and [r.k for r in lost.collect()] == [None]
    why = joins.presence(facts.select("k"), "k", {"first": states.filter("k = 'a'"), "second": states}, "none")
    assert {r.k: r.reason for r in why.collect()} == {"a": "first", "b": "second", "c": "second", None: "none"}


def test_history(spark):
    table = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y")], "k string, v long, w string")
    changes = spark.createDataFrame([("a", 1, "new"), ("b", 4, "old"), ("c", None, "n")], "k string, v long, w string")
    assert {r.k: r.w for r in history.upsert(table, changes, ["k"], "v").collect()} == {"a": "new", "b": "y", "c": "n"}
    top = history.capped(table.unionByName(changes), ["k"], [F.col("v").desc_nulls_last(), F.col("w")], 1)
    assert {(r.k, r.w, r["rank"]) for r in top.collect()} == {("a", "new", 1), ("b", "y", 1), ("c", "n", 1)}


def test_aggregates(spark):
    a = spark.createDataFrame([("x", True), ("x", False), (None, True)], "f string, b boolean")
    b = spark.createDataFrame([("x", True), ("y", True)], "f string, b boolean")
    assert {tuple(r) for r in aggregates.count_deltas(a, b, ["f"]).collect()} == {("f", "x", 2, 1, 1), ("f", "unknown", 1, 0, 1), ("f", "y", 0, 1, -1)}
    assert {(r.f, r.grouping, r.n, r.flagged) for r in aggregates.composition(a, [["f"], []], "b").collect()} == {("x", 0, 2, 1), (None, 0, 1, 1), (None, 1, 3, 2)}
    assert {r.f: r.counts for r in aggregates.nested_counts(a.withColumn("i", F.lit("q")), "f", "i").collect()} == {"x": {"q": 2}, None: {"q": 1}}


def test_rules(spark):
    rs = [rules.Rule("b", 2, ("école",), ("t", "u")), rules.Rule("a", 1, ("x+",), ("t",), case_sensitive=True)]
    df = spark.createDataFrame([(1, "ÉCOLE xx", None), (2, "XX", "école"), (3, None, None)], "id long, t string, u string")
    assert {r.id: (r.matched, r.severity) for r in rules.apply_rules(df, rs).collect()} == {1: (["a", "b"], 2), 2: (["b"], 2), 3: ([], 0)}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_evaluation(spark):
    frame = lambda d: spark.createDataFrame(list(d.items()), "item_id string, text string")
    p = {"1": "שלום", "2": "abc", "3": "same", "4": "", "5": "x" * 300 + "y"}
    r = {"1": "שלם", "3": "same", "4": "", "5": "x" * 299 + "zz", "6": "q"}
    scored = evaluation.score_pairs(spark.createDataFrame([(str(i),) for i in range(1, 8)], "item_id string"), frame(p), frame(r))
    got = {x.item_id: (x.status, x.distance) for x in scored.collect()}
    assert got == {k: ("scored", edit_distance(p[k], r[k])) if k in p and k in r else ("no_reference", None) if k in p else ("no_prediction", None) for k in "1234567"}
    m = evaluation.corpus_metrics(scored).first()
    done = [k for k in p if k in r]
    assert (m.examples, m.scored, m.missing_references) == (7, 4, 1)
    assert m.error_rate == round(sum(edit_distance(p[k], r[k]) for k in done) / sum(len(r[k]) for k in done), 6)
    assert evaluation.corpus_metrics(scored.filter("false")).first().error_rate is None


def test_validation(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "x"), ("b", None, None)], "k string, n long, w string")
    assert [tuple(r) for r in validation.duplicate_keys(df, ["k"]).collect()] == [("a", 2)]
    assert [r.k for r in validation.missing_references(df, "k", df.filter("k = 'a'"), "k").collect()] == ["b"]
    assert [r.reasons for r in validation.row_reasons(df, {"n": F.col("n") > 1, "a": F.col("w") == "x"}).orderBy("k", "n").collect()] == [["n"], [], ["a", "n"]]
    assert {(r.k, r.n, r.w_ok, r.healthy) for r in validation.health(df, "k", {"w_ok": F.col("w") == "x"}).collect()} == {("a", 2, 2, True), ("b", 1, 0, False)}
    assert [tuple(r) for r in validation.conflicting(df, "k", ["n", "w"]).collect()] == [("a", "n", 2)]


def test_stored_lookup_is_the_same_with_and_without_broadcast(spark):
    from ledgerloom.operators import skew

    left = spark.createDataFrame([(i, i % 7 or None) for i in range(60)], "v int, k int")
    right = spark.createDataFrame([(1, "a"), (2, None), (9, "c")], "k int, w string")
    for how in ("inner", "left"):
        got = [sorted(map(str, skew.lookup_stored(left, right, "k", how, most).collect())) for most in (0, 1 << 20)]
        assert got[0] == got[1]
    assert skew.is_small(right.limit(0), 0) and not skew.is_small(right, 10)


def test_local_paths_and_long_numbers(spark):
    paths = {"package://x/.work/y": False, "https://a/.work/b": False, "file:///x": True, "\\\\host\\share": True, "C:\\x": True, "data/.work/x": True, "data\\.work\\x": True, "/x": True, "~/x": False, "data/x": False, "": False}
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", tx.looks_local(F.col("p")).alias("l")).collect()
    assert {r.p: r.l for r in got} == paths
    names = ["v9", "v10", "v007", "v111111111111111111111", "v111111111111111111119", "v2" + "0" * 40, "v0"]
    keys = spark.createDataFrame([(n,) for n in names], "n string").select("n", tx.natural_key(F.col("n")).alias("k")).orderBy("k").collect()
    assert [r.n for r in keys] == sorted(names, key=lambda n: int(n[1:])) and len({r.k for r in keys}) == len(names)


def test_as_of_join_over_buckets(spark):
    import datetime as dt
    import random

    rng = random.Random(8)
    t = lambda: dt.datetime(2020, 1, 1) + dt.timedelta(days=rng.randrange(900))
    facts = [(i, rng.choice(["hot", "hot", "a", "b", None]), t()) for i in range(200)]
    states = {(rng.choice(["hot", "a", "c"]), t()): rng.choice([None, "x", "y", "z"]) for _ in range(60)}
    f = spark.createDataFrame(facts, "id int, k string, at timestamp")
    s = spark.createDataFrame([(k, at, v) for (k, at), v in states.items()], "k string, since timestamp, v string")

    def brute(k, at):
        known = [(since, v) for (key, since), v in states.items() if key == k and since <= at]
        return max(known, key=lambda x: x[0])[1] if known else None

    want = {i: brute(k, at) for i, k, at in facts}
    for bucket in ("day", "month", "year"):
        assert {r.id: r.v for r in joins.range_lookup(f, "k", "at", s, "since", ["v"], bucket).collect()} == want

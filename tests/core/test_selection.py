from pyspark.sql import functions as F

from ledgerloom.operators import nested, selection


def test_sources_and_caps(spark):
    df = spark.createDataFrame([("b", 1, True), ("a", 2, False), ("a", 3, None), ("c", 4, True), ("a", 5, True), ("a", 6, True)], "s string, id long, syn boolean")
    assert {(r.s, r.source_rank) for r in selection.ordered_sources(df, "s", ["b", "c", "a"], ["c"]).collect()} == {("b", 1), ("a", 2)}
    assert selection.ordered_sources(df, "s", []).count() == 0
    kept = selection.cap_share(df, "syn", ["s"], [F.col("id")], 0.5)
    # two real rows allow two synthetic ones; without real rows there are none
    assert sorted(r.id for r in kept.collect()) == [2, 3, 5, 6]
    assert sorted(r.id for r in selection.cap_share(df, "syn", ["s"], [F.col("id")], 0.34).collect()) == [2, 3, 5]
    assert selection.cap_share(df, "syn", ["s"], [F.col("id")], 1.0).count() == 6


def test_keep_first_and_promote(spark):
    a = spark.createDataFrame([("k", 2), ("k", 1)], "k string, v long")
    b = spark.createDataFrame([("k", 0), ("l", 9)], "k string, v long")
    assert {tuple(r) for r in selection.keep_first([a, b], "k", ["v"]).collect()} == {("k", 1), ("l", 9)}
    target, catalogue = selection.promote(a.filter("v = 2"), b, b.filter("k = 'k'"), "k")
    assert {tuple(r) for r in target.collect()} == {("k", 0)} and {tuple(r) for r in catalogue.collect()} == {("l", 9)}


def test_signature_and_templates(spark):
    df = spark.createDataFrame([([-1.0, 1.0],), ([-0.99, 5.0],), ([0.0, 0.0],), (None,)], "v array<float>")
    a, b, c, d = (r.x for r in df.select(selection.quantised_signature(F.col("v")).alias("x")).collect())
    assert a == b and a is not None and c is None and d is None
    assert [tuple(r) for r in selection.template_rows(spark, 3, ["t", "u"]).collect()] == [("synthetic-1", "t"), ("synthetic-2", "u"), ("synthetic-3", "t")]


def test_nested(spark):
    df = spark.createDataFrame(
        [("r", ["a", "a", "b"], ["a", "c", None], [("s1", 0, 2, "ab"), ("s2", 2, 1, "ab"), ("s3", 0, 3, "ab"), ("s4", None, 1, "x")], [("g1", "box", [1, 2, 3, 4], None), ("g2", "polygon", None, [1, 2]), ("g3", "odd", None, None)], {"x": True, "y": False})],
        "k string, ids array<string>, links array<string>, spans array<struct<id: string, start: int, end: int, text: string>>, regions array<struct<id: string, kind: string, box: array<int>, polygon: array<int>>>, flags map<string, boolean>",
    )
    assert [tuple(r) for r in nested.duplicate_parts(df, "k", F.col("ids"), "twice").collect()] == [("r", "a", "twice")]
    assert [tuple(r) for r in nested.broken_links(df, "k", F.col("links"), F.col("ids"), "lost").collect()] == [("r", "c", "lost")]
    assert {r.part for r in nested.bad_offsets(df, "k", "spans").collect()} == {"s2", "s3", "s4"}
    assert {r.part for r in nested.incomplete_geometry(df, "k", "regions").collect()} == {"g2", "g3"}
    assert [r.name for r in nested.uncovered(df, "flags").collect()] == ["y"]

import datetime as dt
import random

import numpy as np
import pytest

from ledgerloom.functions import bitmaps
from ledgerloom.operators import snapshots

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ver string, key string, split string, assets array<struct<p: string>>, score double, key_rank string, taken timestamp, arrived timestamp"


def brute(rows):
    versions = sorted({r[0] for r in rows}, key=lambda v: min(r[6] for r in rows if r[0] == v))
    kept = {}
    for r in rows:
        old = kept.get((r[0], r[1]))
        if old is None or r[7] > old[7]:
            kept[r[0], r[1]] = r
    out = set()
    for a, b in zip(versions, versions[1:]):
        for k in {k for v, k in kept if v in (a, b)}:
            x, y = kept.get((a, k)), kept.get((b, k))
            if x is None or y is None:
                out.add((a, b, k, "added" if x is None else "removed"))
                continue
            out |= {(a, b, k, n) for n, i in (("split", [2]), ("assets", [3]), ("metadata", [4, 5])) if any(x[j] != y[j] for j in i)}
    return out


def changes(df, **kw):
    got = snapshots.snapshot_changes(df, "key", "ver", "taken", "arrived", {"split": ["split"], "assets": ["assets"]}, **kw)
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("rows_per_block", [3, 40_000])
def test_random_snapshots(spark, rows_per_block):
    rng = random.Random(6)
    rows = []
    for v in range(4):
        for k in rng.sample(range(60), 45):
            for _ in range(rng.choice([1, 1, 1, 3])):
                assets = rng.choice([None, [], [("a",)], [("a",), ("b",)], [("b",), ("a",)], [(None,)]])
                rows.append((f"v{9 + v}", rng.choice([f"k{k}", f"k{k}"]), rng.choice([None, "train", "test"]), assets, rng.choice([None, 0.5, 0.25]), rng.choice([None, "", "~", "1:x"]), T0 + dt.timedelta(days=v), T0 + dt.timedelta(seconds=rng.randrange(10**7))))
    rows += rows[:20]
    assert changes(spark.createDataFrame(rows, SCHEMA), rows_per_block=rows_per_block) == brute(rows)


def test_defined_cases(spark):
    row = ("a", None, "s", None, None, None, T0, T0)
    df = spark.createDataFrame([row, ("b", None, "t", None, float("nan"), None, T0 + dt.timedelta(1), None)], SCHEMA)
    assert changes(df) == {("a", "b", None, "split"), ("a", "b", None, "metadata")}
    assert changes(df.limit(0)) == set()
    assert changes(spark.createDataFrame([row], SCHEMA)) == set()
    same = spark.createDataFrame([("a", "k", "s", [("x",)], -0.0, "q" * 50_000, T0, T0), ("b", "k", "s", [("x",)], 0.0, "q" * 50_000, T0 + dt.timedelta(1), T0)], SCHEMA)
    assert changes(same) == set()


def test_a_hot_key_is_reduced_before_it_moves(spark):
    df = spark.createDataFrame([(f"v{i % 2}", "hot", f"s{i}", None, None, None, T0 + dt.timedelta(i % 2), T0 + dt.timedelta(seconds=i)) for i in range(3000)], SCHEMA)
    assert changes(df) == {("v0", "v1", "hot", "split")}


@pytest.mark.parametrize("density", [0.0, 0.001, 0.3, 0.999, 1.0])
def test_bitmaps(density):
    rng = np.random.default_rng(3)
    a, b = (np.flatnonzero(rng.random(200_000) < d) for d in (density, 0.4))
    x, y = bitmaps.compress(a), bitmaps.compress(b)
    assert np.array_equal(bitmaps.positions(x), a)
    assert np.array_equal(bitmaps.and_not(x, y), np.setdiff1d(a, b)) and np.array_equal(bitmaps.and_not(y, x), np.setdiff1d(b, a))
    assert np.array_equal(bitmaps.intersect(x, y), np.intersect1d(a, b))
    assert bitmaps.n_bytes(x) <= 4 * (1 << 13)
    if density == 1.0:
        assert bitmaps.n_bytes(x) == 16


def test_ordinals_do_not_move(spark):
    old = [(f"k{i}", 1) for i in range(50)]
    new = old + [(f"k{i}", 2) for i in range(25, 80)]
    at = [{r.key: (r.block, r.position) for r in snapshots.assign_ordinals(spark.createDataFrame(rows, "key string, rank int"), 4).collect()} for rows in (old, new)]
    assert all(at[1][k] == p for k, p in at[0].items())
    assert len(set(at[1].values())) == 80


def test_stored_ordinals_do_not_move(spark, tmp_path):
    path = str(tmp_path / "ordinals")

    def row(v, k, split="s"):
        return (f"v{v}", k, split, None, None, None, T0 + dt.timedelta(v), T0)

    def run(versions, keys, rows_per_block):
        df = spark.createDataFrame([row(v, f"k{i}", "t" if i % 9 == v else "s") for v in versions for i in keys(v)] + [row(versions[0], None)], SCHEMA)
        got = changes(df, ordinals=path, rows_per_block=rows_per_block)
        return got, {r.key: (r.block, r.position) for r in snapshots.stored_ordinals(spark, path, "string").collect()}

    _, first = run([3, 4], lambda v: range(50 * (v - 3), 3000), 100_000)
    # a snapshot that arrives late and one that brings more keys than all before
    got, then = run([2, 3, 4, 5], lambda v: range(50 * abs(v - 3), 3000 if v < 5 else 9000), 500)
    assert all(then[k] == at for k, at in first.items()) and len(then) == 9001 == len(set(then.values()))
    assert {k for a, b, k, kind in got if (a, b, kind) == ("v4", "v5", "added")} == {f"k{i}" for i in range(3000, 9000)}
    assert {k for a, b, k, kind in got if (a, b, kind) == ("v2", "v3", "added")} == {f"k{i}" for i in range(50)}
    assert ("v2", "v3", None, "removed") in got


def test_nested_values_are_compared_exactly(spark):
    schema = "ver string, key string, split string, assets array<struct<p: timestamp, q: double, m: map<string,int>>>, taken timestamp, arrived timestamp"
    t = dt.datetime(2024, 1, 1, 1, 2, 3, 123456)

    def table(a, b):
        return spark.createDataFrame([("a", "k", "s", a, T0, T0), ("b", "k", "s", b, T0 + dt.timedelta(1), T0)], schema)

    base = [(t, 0.0, {"x": 1, "y": 2})]
    assert changes(table(base, [(t.replace(microsecond=123999), 0.0, {"x": 1, "y": 2})])) == {("a", "b", "k", "assets")}
    assert changes(table(base, [(t, -0.0, {"y": 2, "x": 1})])) == set()
    assert changes(table(base, [(t, 0.0, {"x": 1, "y": 3})])) == {("a", "b", "k", "assets")}
    assert changes(table([None], [(None, None, None)])) == {("a", "b", "k", "assets")}
    assert changes(table([], None)) == {("a", "b", "k", "assets")}

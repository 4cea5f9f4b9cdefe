import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import grouped_splits as gs


def brute_groups(ids, ties):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by_key = {}
    for key, i in ties:
        if key is not None and i in parent:
            by_key.setdefault(key, []).append(i)
    for members in by_key.values():
        for m in members[1:]:
            a, b = find(members[0]), find(m)
            if a != b:
                parent[max(a, b)] = min(a, b)
    sizes = {}
    for i in ids:
        sizes[find(i)] = sizes.get(find(i), 0) + 1
    return {i: (find(i), sizes[find(i)] > 1) for i in ids}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components_match_union_find(spark, shape):
    rng = random.Random(3)
    ids = [f"r{i:03d}" for i in range(60)] + ["é", "Z"]
    if shape == "random":
        ties = [(f"k{rng.randrange(40)}", rng.choice(ids)) for _ in range(70)] + [(None, ids[0]), (None, ids[1]), ("k1", "no-such"), ("k1", None)]
    elif shape == "chain":
        order = ids[::-1]
        ties = [(f"c{i}", order[i + d]) for i in range(39) for d in (0, 1)]
    elif shape == "star":
        ties = [("hot", i) for i in ids] * 2
    else:
        ties = []
    records = spark.createDataFrame([(i, "clash") for i in [*ids, ids[0], None]], "id string, root string")
    frame = spark.createDataFrame(ties, "key string, id string")
    got = {r["id"]: (r.group_id, r.tied) for r in gs.groups(records, frame).collect()}
    assert got == brute_groups(ids, ties)


def test_choose_is_closest():
    rng = random.Random(5)
    for _ in range(200):
        sizes = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        flat = [s for s, n in sizes.items() for _ in range(n)]
        sums = {0}
        for s in flat:
            sums |= {x + s for x in sums}
        target = rng.randrange(0, sum(flat) + 1)
        taken = gs.choose(sizes, target)
        assert all(0 <= n <= sizes[s] for s, n in taken.items())
        got = sum(s * n for s, n in taken.items())
        assert abs(got - target) == min(abs(x - target) for x in sums)
    # beyond the bitset the largest groups that fit come first
    taken = gs.choose({1: 50, 100: 20, 7: 3}, 1234, bits=64)
    assert sum(s * n for s, n in taken.items()) == 1234


def test_assignment(spark):
    rows = [(f"g{i}-{j}", f"g{i}") for i in range(40) for j in range(1 + i % 5)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "id string, group_id string, split string")
    got = gs.assign(df, [("train", 0.8), ("validation", 0.1), ("test", 0.1)]).collect()
    counts = {s: sum(r.split == s for r in got) for s in ("train", "validation", "test")}
    assert len(got) == len(rows) and counts == {"train": 96, "validation": 12, "test": 12}
    assert len({(r.group_id, r.split) for r in got}) == 40
    assert gs.assign(df.limit(0), [("train", 0.8), ("test", 0.2)]).count() == 0


def test_keys(spark):
    works = {"KVR 101446-page-22": "KVR-101446", "kvr.101446_p3": "KVR-101446", "Kvr_101446/f9v": "KVR-101446", "KVR101446 (4)": "KVR-101446", "n/a": None, "0": None, "s.n.": None, "": None, None: None}
    names = {
        "A–B Mühlen Letters / Town Library": "a b muhlen letters",
        "TOWN LIBRARY: A-B MÜHLEN LETTERS": "a b muhlen letters",
        " A-B  Mühlen Letters (Town Library).": "a b muhlen letters",
        "A-B Mühlen Letters/Town": "a b muhlen letters",
        "A-B Mühlen Letters II / Town": "a b muhlen letters ii",
        "Unknown collection": None,
        "n/a": None,
        "-": None,
        "ללא אוסף": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in works], "v string")
    assert {r.v: r.k for r in df.select("v", gs.work_key(F.col("v")).alias("k")).collect()} == works
    df = spark.createDataFrame([(k,) for k in names], "v string")
    assert {r.v: r.k for r in df.select("v", gs.collection_key(F.col("v")).alias("k")).collect()} == names


def test_ampersand_is_and(spark):
    names = {"X Deeds & Oaths / Town": "x deeds and oaths", "TOWN: X DEEDS AND OATHS": "x deeds and oaths", "X Deeds&Oaths (Town)": "x deeds and oaths", "X Deeds Oaths": "x deeds oaths", "&": None}
    df = spark.createDataFrame([(k,) for k in names], "v string")
    assert {r.v: r.k for r in df.select("v", gs.collection_key(F.col("v")).alias("k")).collect()} == names


def test_choose_is_closest_for_any_target():
    # taking the largest group first misses the exact total
    assert gs.choose({20: 1, 3: 7}, 21, bits=8) == {3: 7}
    assert gs.choose({20_000_000: 1, 3_000_000: 7}, 21_000_000) == {3_000_000: 7}

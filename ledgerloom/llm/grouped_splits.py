"""Splits that keep related records together.

Records are tied by keys (work, collection, deposit). Each key is replaced by a
star: its records point to the smallest id among them, so a key with a third of
all records gives as many edges as records, not pairs. Components come from
hooking and shortcutting over a parent table:

* hooking: every vertex takes its smallest neighbour, if smaller, as parent;
* shortcutting: parents are replaced by grandparents until the trees are flat;
* edges are rewritten to the roots, equal ones and loops go, and the next round
  works on what is left. The smallest id of a component never gets a parent, so
  it ends as the root of all its records.

Split totals: components count by size. Over the sizes and their multiplicities
a bitset of reachable sums gives, for each held-out split in turn, the sum
closest to its share. Only these counts reach the driver: there are at most
sqrt(2n) different sizes.

All joins look up a table with one row a key and take the few keys that hold
many rows by broadcast (:mod:`ledgerloom.operators.skew`). Each round's tables
are written to the shared folder, which cuts lineage.

Defined cases: a null id names no record and gives no row; an id that occurs
more than once is one record; null keys and keys that name nothing tie
nothing; empty tables give no rows; of two equally close totals the smaller is
taken; between groups of one size a hash of the group id decides.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.operators.skew import lookup
from ledgerloom.storage import materialize, materialize_with

#: bits of the reachable-sum bitset that are unpacked at a time
SUM_BITS = 1 << 24
RANK_BLOCK = 50_000


def star_edges(ties: DataFrame) -> DataFrame:
    """(a, b), a > b: each record of a key with the key's smallest record. ``ties`` has (key, id)."""
    ties, seen = materialize_with(ties.filter(F.col("key").isNotNull() & F.col("id").isNotNull()).distinct(), "ties", n=F.count("*"))
    centres = ties.groupBy("key").agg(F.min("id").alias("b"), F.max("id").alias("__last")).filter("b < __last").drop("__last")
    return lookup(ties, centres, "key", seen["n"]).filter(F.col("id") > F.col("b")).select(F.col("id").alias("a"), "b").distinct()


def _flatten(parents: DataFrame, n: int) -> DataFrame:
    """Shortcuts ``parents`` (v, p) of ``n`` rows, every root pointing to itself, until p is a root; two shortcuts a job."""
    moved = 1
    while moved:
        up = parents.select(F.col("v").alias("p"), F.col("p").alias("g"))
        once = lookup(parents, up, "p", n).select("v", F.col("g").alias("p"))
        twice = lookup(once, up, "p", n).select("v", F.col("g").alias("p"), (F.col("p") != F.col("g")).alias("moved"))
        parents, seen = materialize_with(twice, "parents", moved=F.count_if("moved"))
        parents, moved = parents.select("v", "p"), seen["moved"]
    return parents


def components(edges: DataFrame) -> DataFrame:
    """(id, root) for every vertex of ``edges`` (a, b); the root is the smallest id of the component."""
    edges, seen = materialize_with(edges, "edges", n=F.count("*"))
    labels = None
    while n := seen["n"]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooked = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p"))
        hooked, vertices = materialize_with(hooked, "hooked", n=F.count("*"))
        roots = _flatten(hooked, vertices["n"])
        # vertices that earlier rounds merged follow their root, if it has one now
        if labels is None:
            labels = roots.select(F.col("v").alias("id"), F.col("p").alias("root"))
        else:
            higher = roots.select(F.col("v").alias("root"), F.col("p").alias("top"))
            labels = materialize(lookup(labels, higher, "root", how="left").select("id", F.coalesce("top", "root").alias("root")), "labels")
        # every vertex of the edges has a root; renaming keeps their number
        for end, other in (("a", "b"), ("b", "a")):
            up = roots.select(F.col("v").alias(end), F.col("p").alias("__root"))
            edges = lookup(edges, up, end, n).select(F.col("__root").alias(end), other)
        edges = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        edges, seen = materialize_with(edges, "edges", n=F.count("*"))
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def groups(records: DataFrame, ties: DataFrame) -> DataFrame:
    """(id, group_id, tied) for each distinct id of ``records`` (id)."""
    ids = records.select("id").filter(F.col("id").isNotNull()).distinct()
    known = ties.join(ids, "id", "left_semi")
    found = components(star_edges(known))
    joined = ids.join(found, "id", "left")
    return joined.select("id", F.coalesce("root", "id").alias("group_id"), F.col("root").isNotNull().alias("tied"))


def choose(multiplicity: dict[int, int], target: int, bits: int = SUM_BITS) -> dict[int, int]:
    """How many groups of each size to take so that their sum is closest to ``target``.

    Exact for any target, on a bitset of reachable sums. For each sum the step
    that first reached it is kept, 4 bytes a sum, unpacked ``bits`` at a time.
    """
    # a sum beyond the target can be the closest one; it is less than twice the target, as 0 is reachable
    limit = 2 * target + 1
    mask = (1 << (limit + 1)) - 1
    first = np.zeros(limit + 1, dtype=np.int32)
    reach, steps = 1, []
    for size in sorted((s for s, n in multiplicity.items() if n), reverse=True):
        n, part = multiplicity[size], 1
        # once the target itself is reached, nothing is closer
        while n and size * part <= limit and not reach >> target & 1:
            k = min(part, n)
            grown = reach | (reach << (size * k)) & mask
            if grown != reach:
                steps.append((size, k))
                raw = np.frombuffer((grown ^ reach).to_bytes(limit // 8 + 1, "little"), dtype=np.uint8)
                for at in range(0, len(raw), max(1, bits // 8)):
                    new = np.flatnonzero(np.unpackbits(raw[at : at + max(1, bits // 8)], bitorder="little"))
                    first[new + at * 8] = len(steps)
                reach = grown
            n, part = n - k, part * 2
    best = next(t for d in range(target + 2) for t in (target - d, target + d) if t >= 0 and reach >> t & 1)
    taken: dict[int, int] = {}
    while best:
        # the sum without this step's groups was reached by an earlier step
        size, k = steps[first[best] - 1]
        best -= size * k
        taken[size] = taken.get(size, 0) + k
    return taken


def _rank_within_size(sized: DataFrame, n_groups: int) -> DataFrame:
    """``sized`` (group_id, size) with a rank from 0 among groups of equal size.

    Groups of one size may be nearly all groups, so they are ranked in blocks
    of a hash and the blocks' counts are added up.
    """
    blocks = max(1, -(-n_groups // RANK_BLOCK))
    spread = sized.withColumn("h", F.xxhash64("group_id")).withColumn("block", F.pmod("h", F.lit(blocks)))
    counts = spread.groupBy("size", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("size").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("size", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("size", "block").orderBy("h", "group_id")) - 1
    return spread.withColumn("at", inside).join(offsets, ["size", "block"]).select("group_id", "size", (F.col("at") + F.col("offset")).alias("rank"))


def assign(grouped: DataFrame, shares: Sequence[tuple[str, float]]) -> DataFrame:
    """(id, group_id, split) for ``grouped`` (id, group_id); the first split of ``shares`` takes what is left."""
    sized = materialize(grouped.groupBy("group_id").agg(F.count("*").alias("size")), "sizes")
    histogram = {r["size"]: r["n"] for r in sized.groupBy("size").agg(F.count("*").alias("n")).collect()}
    total, n_groups = sum(s * n for s, n in histogram.items()), sum(histogram.values())
    left, cuts = dict(histogram), []
    for name, share in shares[1:]:
        taken = choose(left, round(share * total))
        for size, n in taken.items():
            cuts.append((size, histogram[size] - left[size], histogram[size] - left[size] + n, name))
            left[size] -= n
    spark = grouped.sparkSession
    # one row for each size and held-out split: at most sqrt(2n) sizes
    table = spark.createDataFrame(cuts, "s long, low long, high long, split string")
    ranked = _rank_within_size(sized, n_groups)
    placed = ranked.join(F.broadcast(table), (F.col("size") == F.col("s")) & F.col("rank").between(F.col("low"), F.col("high") - 1), "left")
    splits = placed.select("group_id", F.coalesce("split", F.lit(shares[0][0])).alias("split"))
    return lookup(grouped.select("id", "group_id"), splits, "group_id").select("id", "group_id", "split")


# --- keys as people write them -------------------------------------------------

#: values that stand for "none", in the plain form of ``plain_words``
NO_WORK = ("", "0", "n a", "s n", "none", "unknown", "see title", "tbd", "null", "nan", "untitled", "not known")
NO_COLLECTION = ("", "unknown collection", "uncatalogued", "n a", "various", "tbd", "miscellaneous", "ללא אוסף", "none", "unknown", "null", "s n")


def plain_words(col: Column) -> Column:
    """Lower case without accents, every run of other characters one blank.

    Accents are undone for the Latin letters that carry them; letters of other
    scripts stay as they are.
    """
    marked = "áàâäãåāéèêëēíìîïīóòôöõøōúùûüūýÿñçšžčřßłđ"
    bare = "aaaaaaaeeeeeiiiiiooooooouuuuuyyncszcrsld"
    low = F.lower(F.regexp_replace(col, r"[̀-ͯ]", ""))
    return F.trim(F.regexp_replace(F.translate(low, marked, bare), r"[^\p{L}\p{N}]+", " "))


def _unless(col: Column, nothing: Sequence[str]) -> Column:
    """``col``, or null if it is one of the values; ``col`` is computed once, which a condition on itself would not do."""
    return F.get(F.filter(F.array(col), lambda x: ~x.isin(list(nothing))), F.lit(0))


def work_key(col: Column) -> Column:
    """Shelf mark and number of an upstream identifier; page and leaf are left off.

    A value not written as letters and a number counts as a whole.
    """
    text = F.upper(F.trim(col))
    head = r"^\s*(\p{L}+)[\s._-]*0*(\d+)"
    mark = F.concat(F.regexp_extract(text, head, 1), F.lit("-"), F.regexp_extract(text, head, 2))
    return F.when(text.rlike(head), mark).otherwise(_unless(plain_words(col), NO_WORK))


def collection_key(col: Column) -> Column:
    """The collection of "collection / holder", "holder: collection" or "collection (holder)"; "&" is read as "and"."""
    bare = F.regexp_replace(col, r"\s*\([^()]*\)[\s.]*$", "")
    own = F.regexp_replace(F.regexp_replace(bare, r"^[^:/]*:", ""), r"/.*$", "")
    # "n/a" has a slash but no holder
    whole = _unless(plain_words(col), NO_COLLECTION)
    return F.when(whole.isNotNull(), _unless(plain_words(F.regexp_replace(own, "&", " and ")), NO_COLLECTION))


def deposit_key(col: Column) -> Column:
    return _unless(plain_words(col), NO_WORK)

"""Selections, signatures and checks of nested rows over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import dedupe, history, nested, selection
from ledgerloom.storage import table

INCLUDE, EXCLUDE = ["drashiane_scan", "quay_open", "draraova_loan", "draneolm_open"], ["draraova_loan"]


def source_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = selection.ordered_sources(table(spark, sf_dir, "documents"), "source", INCLUDE, EXCLUDE)
    return docs.groupBy("source", "source_rank").agg(F.count("*").alias("n"))


def limit_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 oldest documents of each source: a per-source limit."""
    docs = history.capped(table(spark, sf_dir, "documents"), ["source"], [F.col("created_at").asc_nulls_last(), F.col("doc_id")], 20)
    return docs.select("source", "doc_id", F.col("rank").cast("long").alias("rank"))


def synthetic_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each release with synthetic items kept up to a fifth of what remains."""
    items = table(spark, sf_dir, "exported_items").select("release_version", "item_id", "is_synthetic").distinct()
    return selection.cap_share(items, "is_synthetic", ["release_version"], [F.col("item_id")], 0.2)


_CAP = """
WITH items AS (SELECT DISTINCT release_version, item_id, is_synthetic FROM exported_items),
real AS (SELECT release_version, floor(count(*) * 0.2::DOUBLE / (1 - 0.2::DOUBLE)) AS most FROM items WHERE NOT coalesce(is_synthetic, false) GROUP BY 1)
SELECT release_version, item_id, is_synthetic FROM items WHERE NOT coalesce(is_synthetic, false)
UNION ALL SELECT release_version, item_id, is_synthetic FROM (
  SELECT *, row_number() OVER (PARTITION BY release_version ORDER BY item_id) AS rank FROM items WHERE is_synthetic) LEFT JOIN real USING (release_version) WHERE rank <= coalesce(most, 0)"""


def embedding_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors by the hash of their values cut to 16 levels, as counts of signatures by members."""
    vectors = table(spark, sf_dir, "embeddings").select(selection.quantised_signature(F.col("embedding"), 16).alias("signature"))
    return dedupe.shared_keys(vectors, "signature", 1).groupBy("members").agg(F.count("*").alias("signatures"))


_SIGNATURES = """
SELECT members, count(*) AS signatures FROM (SELECT sha256(array_to_string(l, ',')) AS signature, count(*) AS members FROM (
  SELECT list_transform(embedding, lambda x: least(15, greatest(0, floor((x::DOUBLE + 1) * 8)))::INT) AS l FROM embeddings)
  WHERE len(list_distinct(l)) > 1 GROUP BY 1) GROUP BY 1"""


def first_mention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each item id is known from first: releases, then rights results, then documents."""

    def named(name: str, at: str) -> DataFrame:
        return table(spark, sf_dir, name).filter("item_id IS NOT NULL").groupBy("item_id").agg(F.min(at).alias("first_at")).withColumn("origin", F.lit(name))

    return selection.keep_first([named("exported_items", "ingested_at"), named("rights_results", "decided_at"), named("documents", "ingested_at")], "item_id", ["first_at"])


_FIRST = """
SELECT item_id, first_at, origin FROM (
  SELECT item_id, min(ingested_at) AS first_at, 'exported_items' AS origin, 0 AS f FROM exported_items WHERE item_id IS NOT NULL GROUP BY 1
  UNION ALL SELECT item_id, min(decided_at), 'rights_results', 1 FROM rights_results WHERE item_id IS NOT NULL GROUP BY 1
  UNION ALL SELECT item_id, min(ingested_at), 'documents', 2 FROM documents WHERE item_id IS NOT NULL GROUP BY 1)
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY f, first_at) = 1"""


def diff_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is wrong inside published diffs: items listed twice, change types that there are not."""
    diffs = table(spark, sf_dir, "release_diffs")
    ids = F.transform("changed_items", lambda i: i["item_id"])
    kinds = F.flatten(F.transform("changed_items", lambda i: F.coalesce(i["change_types"], F.array())))
    known = F.array(*[F.lit(k) for k in ("added", "removed", "split", "assets", "metadata")])
    return nested.duplicate_parts(diffs, "diff_id", ids, "listed_twice").unionByName(nested.broken_links(diffs, "diff_id", kinds, known, "unknown_change")).unionByName(_unknown_items(spark, sf_dir))


def _unknown_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = table(spark, sf_dir, "release_diffs").select("diff_id", "version", "previous_version", F.explode("changed_items").alias("i"))
    known = table(spark, sf_dir, "exported_items").select("release_version", F.col("item_id").alias("part")).distinct()
    in_new = known.withColumnRenamed("release_version", "version")
    in_old = known.withColumnRenamed("release_version", "previous_version")
    lost = listed.select("diff_id", "version", "previous_version", F.col("i.item_id").alias("part")).distinct()
    return lost.join(in_new, ["version", "part"], "left_anti").join(in_old, ["previous_version", "part"], "left_anti").select("diff_id", "part", F.lit("in_neither_release").alias("reason"))


_VIOLATIONS = """
SELECT diff_id, part, 'listed_twice' AS reason FROM (SELECT diff_id, unnest(list_transform(changed_items, lambda i: i.item_id)) AS part FROM release_diffs) GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT DISTINCT diff_id, part, 'unknown_change' FROM (SELECT diff_id, unnest(i.change_types) AS part FROM (SELECT diff_id, unnest(changed_items) AS i FROM release_diffs))
WHERE part NOT IN ('added', 'removed', 'split', 'assets', 'metadata')
UNION ALL SELECT DISTINCT diff_id, i.item_id, 'in_neither_release' FROM (SELECT diff_id, version, previous_version, unnest(changed_items) AS i FROM release_diffs) d
WHERE NOT EXISTS (SELECT 1 FROM exported_items e WHERE e.item_id = d.i.item_id AND e.release_version IN (d.version, d.previous_version))"""


def catalogue_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that move from the depth-only catalogue to the runnable ones once a manifest lists them."""
    records = history.latest(table(spark, sf_dir, "records"), ["id"], [F.col("delivered_at").desc_nulls_last(), F.col("title")]).select("id", "title", F.coalesce("f1_source_depth_only", F.lit(False)).alias("depth"))
    listed = table(spark, sf_dir, "reference_manifest").select(F.col("source_item_id").alias("id")).distinct()
    runnable, catalogue = (records.filter(c).select("id", "title") for c in (~F.col("depth"), F.col("depth")))
    runnable, catalogue = selection.promote(runnable, catalogue, catalogue.join(listed, "id", "left_semi"), "id")
    return runnable.withColumn("state", F.lit("runnable")).unionByName(catalogue.withColumn("state", F.lit("catalogue")))


_PROMOTION = """
SELECT id, title, CASE WHEN NOT coalesce(f1_source_depth_only, false) OR id IN (SELECT source_item_id FROM reference_manifest WHERE source_item_id IS NOT NULL) THEN 'runnable' ELSE 'catalogue' END AS state
FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY delivered_at DESC NULLS LAST, title NULLS FIRST) = 1"""


_PAIRS = [
    (source_selection, "SELECT source, CASE source WHEN 'drashiane_scan' THEN 1 WHEN 'quay_open' THEN 2 ELSE 3 END::BIGINT AS source_rank, count(*) AS n FROM documents WHERE source IN ('drashiane_scan', 'quay_open', 'draneolm_open') GROUP BY 1, 2"),
    (limit_per_source, "SELECT source, doc_id, rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY created_at NULLS LAST, doc_id) AS rank FROM documents) WHERE rank <= 20"),
    (synthetic_cap, _CAP),
    (embedding_signatures, _SIGNATURES),
    (first_mention, _FIRST),
    (diff_violations, _VIOLATIONS),
    (catalogue_promotion, _PROMOTION),
]
QUERIES = {f.__name__: f for f, _ in _PAIRS}
ORACLES = {f.__name__: sql for f, sql in _PAIRS}

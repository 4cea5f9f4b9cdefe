"""Dedupe, groups, splits, leakage and validation over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx
from ledgerloom.operators import aggregates, dedupe, history, joins, splits, validation
from ledgerloom.operators.skew import lookup
from ledgerloom.storage import materialize, table

SHARES = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]
#: sources whose row is kept when texts are equal; all others rank after them
PREFERRED = ["draneolm_open", "quay_open", "drashiane_scan"]

_PRIO = "CASE source WHEN 'draneolm_open' THEN 1 WHEN 'quay_open' THEN 2 WHEN 'drashiane_scan' THEN 3 ELSE 4 END"
_BUCKET = "('0x' || substr(sha256({g}), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0"
_SPLIT = "CASE WHEN " + _BUCKET + " < 0.8 THEN 'train' WHEN " + _BUCKET + " < 0.9 THEN 'validation' ELSE 'test' END"


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    return docs.select("doc_id", "source", "item_id", F.sha2("text", 256).alias("fingerprint"), dedupe.priority(F.col("source"), PREFERRED).alias("prio"))


def _marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    # hashed once: the rows are read several times
    return dedupe.canonical_rows(materialize(_items(spark, sf_dir), "items"), "fingerprint", "doc_id", ["prio"])


_MARKED = f"""
marked AS (SELECT doc_id, source, sha256(text) AS fingerprint,
  count(*) OVER (PARTITION BY sha256(text)) AS cluster_size,
  row_number() OVER (PARTITION BY sha256(text) ORDER BY {_PRIO}, doc_id) AS rn
  FROM documents WHERE text IS NOT NULL)"""


def exact_dedupe_retained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marked(spark, sf_dir).filter("is_canonical").select("doc_id", "source", "fingerprint", "cluster_size")


def exact_dedupe_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialize(_items(spark, sf_dir), "items")
    kept = dedupe.clusters(rows, "fingerprint", "doc_id", ["prio"])
    return lookup(rows, kept, "fingerprint").filter("doc_id <> canonical").select("doc_id", "canonical", "fingerprint")


def exact_dedupe_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.clusters(_items(spark, sf_dir), "fingerprint", "doc_id", ["prio"])


def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hash of the ordered asset paths in canonical JSON."""
    items = table(spark, sf_dir, "exported_items").filter("exported_assets IS NOT NULL")
    paths = F.transform("exported_assets", lambda a: a["release_asset_path"])
    body = F.to_json(F.struct(F.size("exported_assets").alias("asset_count"), paths.alias("asset_paths")), {"ignoreNullFields": "false"})
    return items.select("release_version", "item_id", F.sha2(body, 256).alias("fingerprint")).distinct()


_FINGERPRINT = """
SELECT DISTINCT release_version, item_id, sha256('{"asset_count":' || len(exported_assets) || ',"asset_paths":[' ||
  array_to_string(list_transform(exported_assets, lambda a: coalesce('"' || a.release_asset_path || '"', 'null')), ',') || ']}') AS fingerprint
FROM exported_items WHERE exported_assets IS NOT NULL"""


def near_duplicate_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are equal but for case and white space, where they differ in those."""
    docs = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    signature = F.sha2(F.trim(F.regexp_replace(F.lower("text"), r"[ \t\r\n]+", " ")), 256)
    rows = docs.select(signature.alias("signature"), F.sha2("text", 256).alias("fingerprint"))
    return dedupe.near_clusters(rows, "signature", "fingerprint")


_NEAR = r"""
SELECT signature, count(*) AS members, count(DISTINCT fingerprint) AS fingerprints FROM (
  SELECT sha256(trim(regexp_replace(lower(text), '[ \t\r\n]+', ' ', 'g'))) AS signature, sha256(text) AS fingerprint
  FROM documents WHERE text IS NOT NULL) GROUP BY 1 HAVING count(DISTINCT fingerprint) > 1"""


def source_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages of one work: host and path of their address."""
    pages = table(spark, sf_dir, "seed_pages").select(F.concat_ws("", tx.url_host(F.col("source_url")), F.lower(tx.url_path(F.col("source_url")))).alias("work"))
    groups = dedupe.shared_keys(pages.withColumn("work", F.nullif("work", F.lit(""))), "work")
    return groups.select(tx.stable_id("source-group", F.col("work")).alias("group_id"), "work", "members")


_GROUPS = r"""
SELECT 'source-group:' || substr(sha256(work), 1, 16) AS group_id, work, count(*) AS members FROM (
  SELECT lower(regexp_extract(source_url, '^[a-zA-Z]+://([^/?#]+)', 1)) || lower(regexp_extract(source_url, '^[a-zA-Z]+://[^/?#]+([^?#]*)', 1)) AS work
  FROM seed_pages WHERE source_url IS NOT NULL) WHERE work <> '' GROUP BY work HAVING count(*) >= 2"""


def split_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split by item where a document names one, else by its text."""
    return _split_rows(spark, sf_dir).select("doc_id", "split_group", "split")


def _split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.coalesce(F.nullif("item_id", F.lit("")), F.sha2("text", 256), F.concat(F.lit("doc:"), F.col("doc_id")))
    return table(spark, sf_dir, "documents").select("doc_id", "source", group.alias("split_group")).withColumn("split", splits.pick_split(F.col("split_group"), SHARES))


_ASSIGN = f"""
SELECT doc_id, split_group, {_SPLIT.format(g='split_group')} AS split
FROM (SELECT doc_id, coalesce(nullif(item_id, ''), sha256(text), 'doc:' || doc_id) AS split_group FROM documents)"""


def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_rows(spark, sf_dir).groupBy("source", "split").agg(F.count("*").alias("n"), F.countDistinct("split_group").alias("groups"))


def split_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of exported items that a release put into several splits."""
    items = table(spark, sf_dir, "exported_items").select(
        F.concat_ws("/", "release_version", "split_group_id").alias("split_group"),
        F.concat_ws("/", "release_version", F.lower(F.trim("title"))).alias("same_title"),
        "split",
        "split_group_id",
        "title",
    )
    kinds = items.select(F.when(F.col("split_group_id").isNotNull(), F.col("split_group")).alias("split_group"), F.when(F.col("title").isNotNull(), F.col("same_title")).alias("same_title"), "split")
    return splits.leakage(kinds, ["split_group", "same_title"], "split")


_LEAK = """
SELECT kind, group_id, string_agg(DISTINCT split, ',' ORDER BY split) AS splits, count(*) AS members FROM (
  SELECT 'split_group' AS kind, release_version || '/' || split_group_id AS group_id, split FROM exported_items
  UNION ALL SELECT 'same_title', release_version || '/' || lower(trim(title)), split FROM exported_items)
WHERE split IS NOT NULL AND group_id IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT split) > 1"""


def holdout_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposits with records both inside and outside the test split of the reference manifests."""
    refs = table(spark, sf_dir, "reference_manifest").select(F.lower(F.regexp_replace(F.trim("source_id"), "-", "_")).alias("deposit"), "source_item_id", "benchmark_split")
    per = refs.distinct().groupBy("deposit").agg(
        F.count_if(F.col("benchmark_split") == "test").alias("test_items"),
        F.count_if(F.coalesce(F.col("benchmark_split") != "test", F.lit(True))).alias("other_items"),
    )
    return per.filter("test_items > 0 AND other_items > 0")


_OVERLAP = """
SELECT deposit, count(*) FILTER (benchmark_split = 'test') AS test_items, count(*) FILTER (coalesce(benchmark_split <> 'test', true)) AS other_items
FROM (SELECT DISTINCT lower(replace(trim(source_id), '-', '_')) AS deposit, source_item_id, benchmark_split FROM reference_manifest)
GROUP BY 1 HAVING count(*) FILTER (benchmark_split = 'test') > 0 AND count(*) FILTER (coalesce(benchmark_split <> 'test', true)) > 0"""


def reference_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's best reference state, with a default where no manifest lists it."""
    records = table(spark, sf_dir, "records").select("id").distinct()
    refs = table(spark, sf_dir, "reference_manifest").select(F.col("source_item_id").alias("id"), "public_reference_status", "updated_at", "reference_id")
    order = [F.col("updated_at").desc_nulls_last(), F.col("reference_id"), F.col("public_reference_status")]
    newest = history.latest(refs, ["id"], order).select("id", "public_reference_status")
    return records.join(newest, "id", "left").select("id", F.coalesce("public_reference_status", F.lit("not_listed")).alias("status"))


_STATUS = """
SELECT r.id, coalesce(n.public_reference_status, 'not_listed') AS status FROM (SELECT DISTINCT id FROM records) r
LEFT JOIN (SELECT source_item_id, public_reference_status FROM reference_manifest
  QUALIFY row_number() OVER (PARTITION BY source_item_id ORDER BY updated_at DESC NULLS LAST, reference_id, public_reference_status) = 1) n
ON n.source_item_id = r.id"""


def reference_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections beside what they correct: whether it exists and whether the correction is newer."""
    refs = table(spark, sf_dir, "reference_manifest").groupBy("reference_id").agg(F.max("updated_at").alias("updated_at"), F.max("correction_of").alias("correction_of"))
    old = refs.select(F.col("reference_id").alias("correction_of"), F.col("updated_at").alias("old_at"), F.lit(True).alias("known"))
    fixes = refs.filter("correction_of IS NOT NULL").join(old, "correction_of", "left")
    state = F.when(F.col("known").isNull(), "unknown_target").when(F.col("correction_of") == F.col("reference_id"), "self").when(F.col("updated_at") >= F.col("old_at"), "newer").otherwise("older")
    return fixes.select("reference_id", "correction_of", state.alias("state"))


_CORRECTIONS = """
WITH refs AS (SELECT reference_id, max(updated_at) AS updated_at, max(correction_of) AS correction_of FROM reference_manifest GROUP BY 1)
SELECT a.reference_id, a.correction_of, CASE WHEN b.reference_id IS NULL THEN 'unknown_target' WHEN a.correction_of = a.reference_id THEN 'self'
  WHEN a.updated_at >= b.updated_at THEN 'newer' ELSE 'older' END AS state
FROM refs a LEFT JOIN refs b ON b.reference_id = a.correction_of WHERE a.correction_of IS NOT NULL"""


def missing_item_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why an item that a rights result names is not in the newest release: the first place that knows it."""
    wanted = table(spark, sf_dir, "rights_results").select("item_id").filter("item_id IS NOT NULL").distinct()
    items = table(spark, sf_dir, "exported_items")
    versions = items.groupBy("release_version").agg(F.min("exported_at").alias("at"))
    newest = versions.agg(F.max_by("release_version", "at").alias("release_version"))
    current = items.join(F.broadcast(newest), "release_version", "left_semi")  # one row
    among = {"current": current, "earlier_release": items, "document": table(spark, sf_dir, "documents").filter("item_id IS NOT NULL")}
    return joins.presence(wanted, "item_id", among, "never_exported")


_MISSING = """
WITH newest AS (SELECT release_version FROM exported_items GROUP BY 1 ORDER BY min(exported_at) DESC LIMIT 1)
SELECT item_id, CASE WHEN item_id IN (SELECT item_id FROM exported_items SEMI JOIN newest USING (release_version) WHERE item_id IS NOT NULL) THEN 'current'
  WHEN item_id IN (SELECT item_id FROM exported_items WHERE item_id IS NOT NULL) THEN 'earlier_release'
  WHEN item_id IN (SELECT item_id FROM documents WHERE item_id IS NOT NULL) THEN 'document' ELSE 'never_exported' END AS reason
FROM (SELECT DISTINCT item_id FROM rights_results WHERE item_id IS NOT NULL)"""


def record_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.duplicate_keys(table(spark, sf_dir, "records"), ["id"])


def dangling_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    bad = validation.missing_references(table(spark, sf_dir, "reference_manifest"), "source_item_id", table(spark, sf_dir, "records"), "id")
    return bad.select("source_item_id", "reference_id").distinct()


def seed_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that captures of one seed disagree in."""
    return validation.conflicting(table(spark, sf_dir, "seed_pages"), "seed_id", ["title", "rights", "source_url"])


_CONFLICTS = """
SELECT seed_id, "column", count(*) AS n FROM (
  SELECT DISTINCT seed_id, 'title' AS "column", title AS value FROM seed_pages
  UNION ALL SELECT DISTINCT seed_id, 'rights', rights FROM seed_pages
  UNION ALL SELECT DISTINCT seed_id, 'source_url', source_url FROM seed_pages) GROUP BY 1, 2 HAVING count(*) > 1"""


def page_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons why a captured page is not usable as it is."""
    pages = table(spark, sf_dir, "seed_pages")
    checks = {
        "no_title": F.length(F.trim("title")) > 0,
        "no_description": F.length(F.trim("description")) > 0,
        "no_rights": F.length(F.trim("rights")) > 0,
        "no_assets": F.size("asset_urls") > 0,
        "late": F.col("ingested_at") <= F.col("captured_at") + F.expr("INTERVAL 7 DAYS"),
    }
    return validation.row_reasons(pages, checks).select("page_id", F.array_join("reasons", ",").alias("reasons"))


_CHECKS = """
SELECT page_id, array_to_string(list_sort(list_filter([
  CASE WHEN coalesce(length(trim(title, ' ')), 0) = 0 THEN 'no_title' END, CASE WHEN coalesce(length(trim(description, ' ')), 0) = 0 THEN 'no_description' END,
  CASE WHEN coalesce(length(trim(rights, ' ')), 0) = 0 THEN 'no_rights' END, CASE WHEN coalesce(len(asset_urls), 0) = 0 THEN 'no_assets' END,
  CASE WHEN NOT coalesce(ingested_at <= captured_at + INTERVAL 7 DAYS, false) THEN 'late' END], lambda x: x IS NOT NULL)), ',') AS reasons
FROM seed_pages"""


def source_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source of documents: rows that pass each check."""
    docs = table(spark, sf_dir, "documents")
    checks = {
        "has_text": F.length("text") > 0,
        "has_lang": F.col("lang").isNotNull() & (F.col("lang") != "und"),
        "counted_right": F.col("n_chars") == F.length("text"),
        "in_time": F.col("ingested_at") <= F.col("created_at") + F.expr("INTERVAL 30 DAYS"),
    }
    return validation.health(docs, "source", checks)


_HEALTH = """
SELECT source, count(*) AS n, count(*) FILTER (length(text) > 0) AS has_text, count(*) FILTER (lang IS NOT NULL AND lang <> 'und') AS has_lang,
  count(*) FILTER (n_chars = length(text)) AS counted_right, count(*) FILTER (ingested_at <= created_at + INTERVAL 30 DAYS) AS in_time,
  count(*) = count(*) FILTER (length(text) > 0) AND count(*) = count(*) FILTER (lang IS NOT NULL AND lang <> 'und')
  AND count(*) = count(*) FILTER (n_chars = length(text)) AND count(*) = count(*) FILTER (ingested_at <= created_at + INTERVAL 30 DAYS) AS healthy
FROM documents GROUP BY 1"""


def split_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of each split group in each release, as counts of counts."""
    items = table(spark, sf_dir, "exported_items").filter("split_group_id IS NOT NULL")
    sizes = items.groupBy("release_version", "split_group_id").agg(F.countDistinct("item_id").alias("members"))
    return sizes.groupBy("release_version", "members").agg(F.count("*").alias("groups"))


def classification_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.field_counts(table(spark, sf_dir, "exported_items"), ["content_class", "period_class", "language_class", "quality_tier", "privacy_decision"])


_STATS = " UNION ALL ".join(
    f"SELECT '{f}' AS field, coalesce({f}, 'unknown') AS value, count(*) AS n FROM exported_items GROUP BY 2"
    for f in ("content_class", "period_class", "language_class", "quality_tier", "privacy_decision")
)

_PAIRS = [
    (exact_dedupe_retained, f"WITH {_MARKED} SELECT doc_id, source, fingerprint, cluster_size FROM marked WHERE rn = 1"),
    (exact_dedupe_removed, f"WITH {_MARKED} SELECT a.doc_id, b.doc_id AS canonical, a.fingerprint FROM marked a JOIN marked b ON b.fingerprint = a.fingerprint AND b.rn = 1 WHERE a.rn > 1"),
    (exact_dedupe_clusters, f"WITH {_MARKED} SELECT fingerprint, doc_id AS canonical, cluster_size AS n FROM marked WHERE rn = 1 AND cluster_size > 1"),
    (content_fingerprint, _FINGERPRINT),
    (near_duplicate_clusters, _NEAR),
    (source_groups, _GROUPS),
    (split_assign, _ASSIGN),
    (split_counts, f"SELECT source, split, count(*) AS n, count(DISTINCT split_group) AS groups FROM ({_ASSIGN}) JOIN documents USING (doc_id) GROUP BY 1, 2"),
    (split_leakage, _LEAK),
    (holdout_overlap, _OVERLAP),
    (reference_status, _STATUS),
    (reference_corrections, _CORRECTIONS),
    (missing_item_reason, _MISSING),
    (record_duplicates, "SELECT id, count(*) AS n FROM records GROUP BY 1 HAVING count(*) > 1"),
    (dangling_references, "SELECT DISTINCT source_item_id, reference_id FROM reference_manifest WHERE source_item_id IS NOT NULL AND source_item_id NOT IN (SELECT id FROM records)"),
    (seed_conflicts, _CONFLICTS),
    (page_checks, _CHECKS),
    (source_health, _HEALTH),
    (split_group_sizes, "SELECT release_version, members, count(*) AS groups FROM (SELECT release_version, split_group_id, count(DISTINCT item_id) AS members FROM exported_items WHERE split_group_id IS NOT NULL GROUP BY 1, 2) GROUP BY 1, 2"),
    (classification_stats, _STATS),
]
QUERIES = {f.__name__: f for f, _ in _PAIRS}
ORACLES = {f.__name__: sql for f, sql in _PAIRS}

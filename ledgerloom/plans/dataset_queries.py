"""Classes, rights, decisions, held-out groups, baselines and nested clean-up over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import paths
from ledgerloom.functions import text as tx
from ledgerloom.operators import aggregates, classify, dedupe, decisions, history, holdout, joins, nested, releases, rights, selection, snapshots, splits, validation
from ledgerloom.plans import snapshot_queries
from ledgerloom.plans.release_queries import _LATEST, _current
from ledgerloom.storage import table

ALLOWED = {"historical": ["manuscript", "printed"], "modern": ["printed"]}


def record_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content, period and language class of each record, with confidence, and what is too uncertain."""
    records = table(spark, sf_dir, "records").select("id", "title", "collection", "upstream_identifier", "period", "f1_source_depth_only").distinct()
    allowed = F.when(F.col("period") == "historical", F.array(F.lit("manuscript"), F.lit("printed"))).when(F.col("period") == "modern", F.array(F.lit("printed"))).otherwise(F.array().cast("array<string>"))
    text = classify.combined_text(F.col("title"), F.col("collection"), F.array_compact(F.array("upstream_identifier", "period")))
    synthetic = F.coalesce("f1_source_depth_only", F.lit(False))
    classed = records.withColumn("text", text).select(
        "id",
        classify.content_class(F.col("text"), F.lit(""), allowed).alias("c"),
        classify.period_class(F.col("text"), F.col("period"), synthetic, F.col("id").startswith("pnk"), F.col("id").startswith("ldg")).alias("p"),
        classify.language_class(F.col("text"), synthetic).alias("l"),
    )
    weak = classify.low_confidence(content=F.col("c"), period=F.col("p"), language=F.col("l"))
    reasons = F.array_join(F.array_compact(F.array("c.reason", "p.reason", "l.reason")), ",")
    return classed.select("id", F.col("c.value").alias("content_class"), F.col("p.value").alias("period_class"), F.col("l.value").alias("language_class"), reasons.alias("reasons"), F.array_join(weak, ",").alias("uncertain")).distinct()


_CLASSES = r"""
WITH r AS (SELECT DISTINCT id, title, collection, upstream_identifier, period, f1_source_depth_only FROM records),
t AS (SELECT id, period, coalesce(f1_source_depth_only, false) AS syn, lower(x) AS low, regexp_matches(x, '[\x{0590}-\x{05FF}]') AS h, regexp_matches(x, '[A-Za-z]') AS l FROM (
  SELECT *, trim(concat_ws(' ', coalesce(title, ''), coalesce(collection, ''), concat_ws(' ', upstream_identifier, period)), ' ') AS x FROM r)),
c AS (SELECT id, CASE WHEN low LIKE '%כתב יד%' OR low LIKE '%מכתב%' OR low LIKE '%פנקס%' OR low LIKE '%note%' THEN 'handwritten'
    WHEN low LIKE '%דו"ח%' OR low LIKE '%אישור%' OR low LIKE '%report%' OR low LIKE '%office copy%' THEN 'printed'
    WHEN period = 'historical' THEN 'both' WHEN period = 'modern' THEN 'printed' ELSE 'none' END AS cc,
  CASE WHEN syn THEN 'a' WHEN lower(period) = 'historical' OR id LIKE 'pnk%' THEN 'b' WHEN id LIKE 'ldg%' THEN 'c' WHEN regexp_matches(low, '19[3-9]|20[0-2]') THEN 'd' ELSE 'e' END AS pc,
  CASE WHEN syn THEN 'a' WHEN h AND l THEN 'b' WHEN h THEN 'c' WHEN l THEN 'd' ELSE 'e' END AS lc FROM t)
SELECT DISTINCT id, CASE cc WHEN 'both' THEN 'mixed' WHEN 'none' THEN 'mixed' ELSE cc END AS content_class, CASE pc WHEN 'b' THEN 'historical' ELSE 'modern' END AS period_class,
  CASE lc WHEN 'c' THEN 'hebrew_only' WHEN 'e' THEN 'hebrew_only' ELSE 'mixed_language' END AS language_class,
  concat_ws(',', CASE cc WHEN 'both' THEN 'content_conflicting_source_priors' WHEN 'none' THEN 'content_unknown' END, CASE pc WHEN 'd' THEN 'period_inferred_from_year' WHEN 'e' THEN 'period_source_prior_only' END,
    CASE lc WHEN 'd' THEN 'language_non_hebrew_title' WHEN 'e' THEN 'language_unknown' END) AS reasons,
  concat_ws(',', CASE WHEN cc IN ('both', 'none') THEN 'content_low_confidence' END, CASE WHEN lc = 'e' THEN 'language_low_confidence' END, CASE WHEN pc = 'e' THEN 'period_low_confidence' END) AS uncertain
FROM c"""


def item_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and tier of the items of each release from their assets; sizes stand in for those of the files."""
    items = _current(spark, sf_dir)
    sized = F.transform(F.coalesce("exported_assets", F.array()), lambda a: F.struct((F.length(a["release_asset_path"]) * 20).alias("width"), (F.length(a["release_preview_path"]) * 50).alias("height")))
    return items.select("release_version", "item_id", classify.quality(sized, F.col("is_synthetic")).alias("q")).select("release_version", "item_id", F.col("q.score").alias("score"), F.col("q.tier").alias("tier"))


_QUALITY = f"""
WITH {_LATEST}, m AS (SELECT release_version, item_id, is_synthetic, len(coalesce(exported_assets, [])) AS n,
  list_avg(list_transform(exported_assets, lambda a: coalesce(length(a.release_asset_path) * 20, 0))) AS w, list_avg(list_transform(exported_assets, lambda a: coalesce(length(a.release_preview_path) * 50, 0))) AS h FROM latest),
s AS (SELECT release_version, item_id, least(100, 50 + CASE WHEN n >= 1 THEN 10 ELSE 0 END + CASE WHEN coalesce(w, 0) >= 800 THEN 15 ELSE 0 END + CASE WHEN coalesce(h, 0) >= 1000 THEN 15 ELSE 0 END
  + CASE WHEN is_synthetic THEN 10 ELSE 0 END) / 100.0::DOUBLE AS score FROM m)
SELECT release_version, item_id, score, CASE WHEN score >= 0.8 THEN 'high' WHEN score >= 0.6 THEN 'medium' ELSE 'low' END AS tier FROM s"""

STRATEGIES = [
    ("open", "contains", ["lantern", "quire attribution"], "LOD-1.0", "open"),
    ("loan", "exact_match", ["research use only", "see the depositor"], "QAL-1.0", "open_with_attribution"),
    ("scan", "manual_review", [], "UNKNOWN", "restricted_review_only"),
]


def rights_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rights text by alias, else by the strategy of its kind of deposit."""
    results = table(spark, sf_dir, "rights_results").select("result_id", "raw_text", F.regexp_extract("item_id", "_([a-z]+):", 1).alias("deposit_kind"))
    licences = table(spark, sf_dir, "licenses").select("ord", "id", "aliases", F.col("rights_classification").alias("class"))
    strategies = spark.createDataFrame(STRATEGIES, "source string, type string, values array<string>, license_id string, license_class string")
    return rights.normalise(results, "raw_text", "deposit_kind", licences, strategies).select("result_id", "license_id", "license_class", "matched_by")


_RIGHTS = r"""
WITH r AS (SELECT result_id, lower(regexp_replace(raw_text, '^[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+$', '', 'g')) AS t, regexp_extract(item_id, '_([a-z]+):', 1) AS kind FROM rights_results),
a AS (SELECT label, arg_min(id, ord) AS id, arg_min(rights_classification, ord) AS class FROM (
  SELECT id, ord, rights_classification, lower(trim(unnest(list_concat([id], coalesce(aliases, []))))) AS label FROM licenses) WHERE label <> '' GROUP BY 1),
j AS (SELECT r.result_id, a.id, a.class, CASE WHEN t <> '' AND a.id IS NOT NULL THEN 'alias' WHEN kind = 'loan' AND t IN ('research use only', 'see the depositor') THEN 'exact'
    WHEN kind = 'open' AND t <> '' AND (t LIKE '%lantern%' OR t LIKE '%quire attribution%') THEN 'contains' WHEN kind = 'scan' THEN 'manual' ELSE 'unknown' END AS matched_by
  FROM r LEFT JOIN a ON a.label = r.t)
SELECT result_id, CASE matched_by WHEN 'alias' THEN id WHEN 'exact' THEN 'QAL-1.0' WHEN 'contains' THEN 'LOD-1.0' ELSE 'UNKNOWN' END AS license_id,
  CASE matched_by WHEN 'alias' THEN class WHEN 'exact' THEN 'open_with_attribution' WHEN 'contains' THEN 'open' WHEN 'manual' THEN 'restricted_review_only'
    ELSE (SELECT rights_classification FROM licenses WHERE id = 'UNKNOWN') END AS license_class, matched_by FROM j"""


def _newest_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = _current(spark, sf_dir)
    newest = table(spark, sf_dir, "exported_items").groupBy("release_version").agg(F.min("exported_at").alias("at")).agg(F.max_by("release_version", "at").alias("release_version"))
    return items.join(F.broadcast(newest), "release_version", "left_semi")  # one row


_NEWEST = f"{_LATEST}, newest AS (SELECT * FROM latest WHERE release_version = (SELECT release_version FROM ranked ORDER BY rnk DESC LIMIT 1))"


def merged_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the newest release with the first decision on each: a reference, else a rights result, else none."""
    items = _newest_items(spark, sf_dir).select("item_id", "source_item_id")
    refs = table(spark, sf_dir, "reference_manifest").select(F.col("source_item_id").alias("sid"), "public_reference_status", "updated_at", "reference_id")
    refs = history.latest(refs, ["sid"], [F.col("updated_at").desc_nulls_last(), F.col("reference_id"), F.col("public_reference_status")])
    by_item = items.join(refs, items["source_item_id"] == refs["sid"]).select("item_id", F.col("public_reference_status").alias("outcome"), F.col("reference_id").alias("detail"))
    results = table(spark, sf_dir, "rights_results").filter("item_id IS NOT NULL AND rights_classification IS NOT NULL")
    results = history.latest(results, ["item_id"], [F.col("decided_at").desc_nulls_last(), F.col("result_id")])
    by_right = results.select("item_id", F.col("rights_classification").alias("outcome"), F.col("result_id").cast("string").alias("detail"))
    return decisions.merge(items, "item_id", [("reference", by_item), ("rights", by_right)], ("default", "unresolved"))


_MERGED = f"""
WITH {_NEWEST}, refs AS (SELECT source_item_id, public_reference_status, reference_id FROM reference_manifest
  QUALIFY row_number() OVER (PARTITION BY source_item_id ORDER BY updated_at DESC NULLS LAST, reference_id, public_reference_status) = 1),
rr AS (SELECT item_id, rights_classification, result_id FROM rights_results WHERE item_id IS NOT NULL AND rights_classification IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY decided_at DESC NULLS LAST, result_id) = 1)
SELECT n.item_id, CASE WHEN refs.reference_id IS NOT NULL THEN 'reference' WHEN rr.item_id IS NOT NULL THEN 'rights' ELSE 'default' END AS decision_source,
  CASE WHEN refs.reference_id IS NOT NULL THEN public_reference_status WHEN rr.item_id IS NOT NULL THEN rr.rights_classification ELSE 'unresolved' END AS outcome,
  CASE WHEN refs.reference_id IS NOT NULL THEN refs.reference_id ELSE result_id::VARCHAR END AS detail
FROM newest n LEFT JOIN refs USING (source_item_id) LEFT JOIN rr ON rr.item_id = n.item_id"""


def decision_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of each release with and without a rights result."""
    return decisions.progress(_current(spark, sf_dir), table(spark, sf_dir, "rights_results").filter("item_id IS NOT NULL"), "item_id", "release_version")


_PROGRESS = f"""
WITH {_LATEST} SELECT release_version, count(*) AS total, count(*) FILTER (d) AS decided, count(*) FILTER (NOT d) AS "open" FROM (
  SELECT release_version, coalesce(item_id IN (SELECT item_id FROM rights_results WHERE item_id IS NOT NULL), false) AS d FROM latest) GROUP BY 1"""


def reviewer_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References as one reviewer sees them: which of them that reviewer has."""
    refs = table(spark, sf_dir, "reference_manifest")
    own = refs.select("reference_id", F.explode("reviewers").alias("reviewer"))
    return decisions.own(refs.select("reference_id", "source_id").distinct(), own, "reference_id", "reviewer", "reviewer-15")


def set_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that manifests put into several splits, which must have none in common."""
    refs = table(spark, sf_dir, "reference_manifest")
    return decisions.overlaps({s: refs.filter(F.col("benchmark_split") == s).select("source_item_id") for s in ("train", "validation", "test")}, "source_item_id")


_OVERLAPS = """
SELECT source_item_id, string_agg(DISTINCT benchmark_split, ',' ORDER BY benchmark_split) AS frames FROM reference_manifest
WHERE benchmark_split IN ('train', 'validation', 'test') AND source_item_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT benchmark_split) > 1"""


def mismatched_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References whose item id is not made of their deposit and record."""
    refs = table(spark, sf_dir, "reference_manifest").select("reference_id", "item_id", "source_id", "source_item_id").distinct()
    parts = {"source_id": F.substring_index("item_id", ":", 1), "source_item_id": F.element_at(F.split("item_id", ":"), -1)}
    return validation.unequal(refs, ["reference_id"], {name: (F.col(name), part) for name, part in parts.items()}).select("reference_id", "column").distinct()


_MISMATCHED = """
SELECT DISTINCT reference_id, 'source_id' AS "column" FROM reference_manifest WHERE source_id IS DISTINCT FROM split_part(item_id, ':', 1)
UNION ALL SELECT DISTINCT reference_id, 'source_item_id' FROM reference_manifest WHERE source_item_id IS DISTINCT FROM list_last(string_split(item_id, ':'))"""


def decision_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References to unknown items, and those whose record is another item's."""
    items = _newest_items(spark, sf_dir).select("item_id", "source_item_id")
    return decisions.unknown_targets(table(spark, sf_dir, "reference_manifest").select("item_id", "source_item_id").distinct(), items, "item_id", "source_item_id")


_TARGETS = f"""
WITH {_NEWEST}, i AS (SELECT item_id, source_item_id FROM newest)
SELECT d.item_id, d.source_item_id, CASE WHEN a.item_id IS NULL AND b.item_id IS NULL THEN 'unknown_item' WHEN a.item_id IS NULL THEN 'other_item' ELSE 'mismatch' END AS reason
FROM (SELECT DISTINCT item_id, source_item_id FROM reference_manifest) d LEFT JOIN i a ON a.item_id = d.item_id LEFT JOIN i b ON b.source_item_id = d.source_item_id
WHERE a.item_id IS NULL OR (d.source_item_id IS NOT NULL AND a.source_item_id <> d.source_item_id)"""


def _grouped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    records = table(spark, sf_dir, "records").select("id", F.lower(F.trim("collection")).alias("collection"), F.upper(F.trim("upstream_identifier")).alias("work"))
    refs = table(spark, sf_dir, "reference_manifest").filter("benchmark_split = 'test'").select(F.col("source_item_id").alias("item"), "updated_at")
    return holdout.members(records, "id", ["collection", "work"]), refs


def holdout_risks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections and works on both sides of the test records, beside those accepted when the references of 2024 were all."""
    grouped, refs = _grouped(spark, sf_dir)
    return holdout.resolve(holdout.risks(grouped, refs), holdout.risks(grouped, refs.filter("updated_at < '2025-01-01'")))


_RISKS = """
WITH g AS (SELECT DISTINCT 'collection' AS kind, lower(trim(collection, ' ')) AS group_id, id AS item FROM records WHERE collection IS NOT NULL AND id IS NOT NULL
  UNION ALL SELECT DISTINCT 'work', upper(trim(upstream_identifier, ' ')), id FROM records WHERE upstream_identifier IS NOT NULL AND id IS NOT NULL),
now_ AS (SELECT DISTINCT source_item_id AS item FROM reference_manifest WHERE benchmark_split = 'test'),
then_ AS (SELECT DISTINCT source_item_id AS item FROM reference_manifest WHERE benchmark_split = 'test' AND updated_at < '2025-01-01'),
f AS (SELECT kind, group_id, list_sort(list(item) FILTER (item IN (FROM now_))) AS held, list_sort(list(item) FILTER (item NOT IN (FROM now_ WHERE item IS NOT NULL))) AS others FROM g GROUP BY 1, 2),
a AS (SELECT kind, group_id, list_sort(list(item) FILTER (item IN (FROM then_))) AS held, list_sort(list(item) FILTER (item NOT IN (FROM then_ WHERE item IS NOT NULL))) AS others FROM g GROUP BY 1, 2),
ff AS (SELECT * FROM f WHERE len(held) > 0 AND len(others) > 0), aa AS (SELECT * FROM a WHERE len(held) > 0 AND len(others) > 0)
SELECT coalesce(ff.kind, aa.kind) AS kind, coalesce(ff.group_id, aa.group_id) AS group_id, coalesce(len(ff.held), 0) AS held_out, coalesce(len(ff.others), 0) AS others,
  CASE WHEN ff.kind IS NULL THEN 'unused' WHEN aa.kind IS NULL THEN 'unresolved' WHEN ff.held = aa.held AND ff.others = aa.others THEN 'accepted' ELSE 'stale' END AS status
FROM ff FULL JOIN aa ON ff.kind = aa.kind AND ff.group_id = aa.group_id"""


def split_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The split group of each document: its cluster of equal texts, else its item if several share it, else itself."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "item_id", F.sha2("text", 256).alias("fingerprint"))
    return splits.group_by_precedence(docs, "fingerprint", "item_id", F.concat_ws(":", "source", F.col("doc_id").cast("string"))).select("doc_id", "split_group", "group_kind")


_PRECEDENCE = """
WITH d AS (SELECT doc_id, source, item_id, sha256(text) AS fp FROM documents),
c AS (SELECT fp, count(*) AS n FROM d WHERE fp IS NOT NULL GROUP BY 1), s AS (SELECT item_id, count(*) AS n FROM d WHERE item_id <> '' GROUP BY 1)
SELECT doc_id, CASE WHEN c.n > 1 THEN 'cluster:' || substr(fp, 1, 16) WHEN s.n > 1 THEN 'group:' || d.item_id ELSE concat_ws(':', source, doc_id) END AS split_group,
  CASE WHEN c.n > 1 THEN 'cluster' WHEN s.n > 1 THEN 'group' ELSE 'own' END AS group_kind
FROM d LEFT JOIN c USING (fp) LEFT JOIN s ON s.item_id = d.item_id"""


def leakage_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of four kinds that a release put into several splits: by number of groups and of leaks."""
    items = table(spark, sf_dir, "exported_items")
    of = lambda name, col: F.when(col.isNotNull(), F.concat_ws("/", "release_version", col)).alias(name)
    asset = F.array_join(F.transform("exported_assets", lambda a: a["release_asset_path"]), "|")
    kinds = items.select(
        of("split_group", F.col("split_group_id")), of("duplicate_cluster", F.when(F.size("exported_assets") > 0, asset)), of("near_duplicate", F.lower(F.trim("title"))), of("source_group", F.col("source_item_id")), "split"
    )
    return splits.leakage(kinds, ["split_group", "duplicate_cluster", "near_duplicate", "source_group"], "split").groupBy("kind").agg(F.count("*").alias("leaks"), F.sum("members").alias("members"))


_KINDS = """
SELECT kind, count(*) AS leaks, sum(members)::BIGINT AS members FROM (SELECT kind, release_version, g, count(*) AS members FROM (
  SELECT 'split_group' AS kind, release_version, split_group_id AS g, split FROM exported_items
  UNION ALL SELECT 'duplicate_cluster', release_version, CASE WHEN len(exported_assets) > 0 THEN list_aggregate(list_transform(exported_assets, lambda a: a.release_asset_path), 'string_agg', '|') END, split FROM exported_items
  UNION ALL SELECT 'near_duplicate', release_version, lower(trim(title, ' ')), split FROM exported_items
  UNION ALL SELECT 'source_group', release_version, source_item_id, split FROM exported_items)
WHERE g IS NOT NULL AND split IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT split) > 1) GROUP BY 1"""


def release_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The release that each release is compared with: the latest other one."""
    all_ = table(spark, sf_dir, "exported_items").groupBy("release_version").agg(F.min("exported_at").alias("exported_at"))
    versions = all_.withColumn("rank", F.lit(0)).select("release_version", "exported_at")
    return releases.latest_baseline(versions, "release_version", "exported_at").select("release_version", "exported_at")


def removal_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why the items that a release lost are gone: the first place that knows them."""
    gone = snapshot_queries.p2_found(spark, sf_dir).filter("change_type = 'removed'").select("item_id").distinct()
    among = {
        "blocked": table(spark, sf_dir, "rights_results").filter("rights_classification = 'blocked' AND item_id IS NOT NULL"),
        "in_newest": _newest_items(spark, sf_dir),
        "document": table(spark, sf_dir, "documents").filter("item_id IS NOT NULL"),
    }
    return joins.presence(gone, "item_id", among, "missing").groupBy("reason").agg(F.count("*").alias("n"))


_REMOVAL = f"""
SELECT reason, count(*) AS n FROM (SELECT item_id, CASE WHEN item_id IN (SELECT item_id FROM rights_results WHERE rights_classification = 'blocked' AND item_id IS NOT NULL) THEN 'blocked'
  WHEN item_id IN (WITH {_NEWEST} SELECT item_id FROM newest WHERE item_id IS NOT NULL) THEN 'in_newest'
  WHEN item_id IN (SELECT item_id FROM documents WHERE item_id IS NOT NULL) THEN 'document' ELSE 'missing' END AS reason
  FROM (SELECT DISTINCT item_id FROM ({snapshot_queries._SQL}) WHERE change_type = 'removed')) GROUP BY 1"""


def declared_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that the published diffs count otherwise than the snapshots do."""
    items = table(spark, sf_dir, "release_diffs").select("previous_version", "version", F.explode("changed_items").alias("i"))
    declared = items.select("previous_version", "version", "i.item_id", F.explode("i.change_types").alias("change_type")).distinct()
    keys = ["previous_version", "version", "change_type"]
    count = lambda df: df.groupBy(*keys).agg(F.count("*").alias("n"))
    return releases.count_mismatches(count(declared), count(snapshot_queries.p2_found(spark, sf_dir)), keys)


_DECLARED = f"""
WITH d AS (SELECT previous_version, version, change_type, count(*) AS n FROM (SELECT DISTINCT previous_version, version, i.item_id AS item_id, unnest(i.change_types) AS change_type
  FROM (SELECT previous_version, version, unnest(changed_items) AS i FROM release_diffs)) GROUP BY 1, 2, 3),
a AS (SELECT previous_version, version, change_type, count(*) AS n FROM ({snapshot_queries._SQL}) GROUP BY 1, 2, 3)
SELECT coalesce(d.previous_version, a.previous_version) AS previous_version, coalesce(d.version, a.version) AS version, coalesce(d.change_type, a.change_type) AS change_type,
  coalesce(d.n, 0) AS declared, coalesce(a.n, 0) AS actual
FROM d FULL JOIN a ON d.previous_version = a.previous_version AND d.version = a.version AND d.change_type = a.change_type WHERE coalesce(d.n, 0) <> coalesce(a.n, 0)"""


def balanced_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best 60 real items of the newest release and the best synthetic ones, at most 200 and twice the real ones: a top-k report."""
    order = [F.col("quality_score").desc_nulls_last(), F.col("item_id")]
    return releases.balanced_top(_newest_items(spark, sf_dir), "is_synthetic", order, 60, 200).select("item_id", F.coalesce("is_synthetic", F.lit(False)).alias("is_synthetic"))


_BALANCED = f"""
WITH {_NEWEST}, r AS (SELECT item_id, coalesce(is_synthetic, false) AS is_synthetic, row_number() OVER (PARTITION BY coalesce(is_synthetic, false) ORDER BY quality_score DESC NULLS LAST, item_id) AS rn FROM newest)
SELECT item_id, is_synthetic FROM r WHERE NOT is_synthetic AND rn <= 60
UNION ALL SELECT item_id, is_synthetic FROM r WHERE is_synthetic AND rn <= least(200, 2 * (SELECT count(*) FROM r WHERE NOT is_synthetic AND rn <= 60))"""


def split_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the newest release in listing order: by split, source and id."""
    return releases.ordered(_newest_items(spark, sf_dir), "split", ["source_id", "item_id"]).select("item_id", F.col("place").cast("long").alias("place"))


_LISTING = f"""
WITH {_NEWEST} SELECT item_id, row_number() OVER (ORDER BY CASE split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 WHEN 'test' THEN 2 ELSE 3 END, source_id NULLS FIRST, item_id NULLS FIRST) - 1 AS place FROM newest"""


def reference_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What happened to references between the states at the end of 2024 and now."""
    refs = table(spark, sf_dir, "reference_manifest").filter("reference_id IS NOT NULL")
    order = [F.col("updated_at").desc_nulls_last(), F.col("item_id"), F.col("public_reference_status"), F.col("adjudication_status"), F.col("visibility"), F.col("source_id")]
    now, then = (history.latest(df, ["reference_id"], order) for df in (refs, refs.filter("updated_at < '2025-01-01'")))
    return releases.versioning(then, now, "reference_id", ["change_reason", "reviewers"], ["correction_of"], "change_reason").groupBy("event").agg(F.count("*").alias("n"))


_VERSIONS = """
WITH o AS (SELECT * EXCLUDE (change_reason, reviewers), change_reason FROM reference_manifest WHERE reference_id IS NOT NULL),
n AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY reference_id ORDER BY updated_at DESC NULLS LAST, item_id NULLS FIRST, public_reference_status NULLS FIRST, adjudication_status NULLS FIRST, visibility NULLS FIRST, source_id NULLS FIRST) = 1),
t AS (SELECT * FROM o WHERE updated_at < '2025-01-01' QUALIFY row_number() OVER (PARTITION BY reference_id ORDER BY updated_at DESC NULLS LAST, item_id NULLS FIRST, public_reference_status NULLS FIRST, adjudication_status NULLS FIRST, visibility NULLS FIRST, source_id NULLS FIRST) = 1),
j AS (SELECT t.reference_id AS old_id, n.reference_id AS new_id, n.change_reason AS why,
    row(t.item_id, t.source_id, t.source_item_id, t.benchmark_split, t.visibility, t.public_reference_status, t.adjudication_status, t.correction_of, t.updated_at)
      IS DISTINCT FROM row(n.item_id, n.source_id, n.source_item_id, n.benchmark_split, n.visibility, n.public_reference_status, n.adjudication_status, n.correction_of, n.updated_at) AS differs
  FROM t FULL JOIN n ON t.reference_id = n.reference_id)
SELECT event, count(*) AS n FROM (SELECT CASE WHEN old_id IS NULL THEN 'added' WHEN new_id IS NULL THEN CASE WHEN old_id IN (SELECT correction_of FROM n) THEN 'replaced' ELSE 'disappeared' END
  WHEN differs THEN CASE WHEN length(trim(why, ' ')) > 0 THEN 'changed' ELSE 'changed_without_reason' END END AS event FROM j) WHERE event IS NOT NULL GROUP BY 1"""


def examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark examples: references beside what is exported of them and the text that transcribes them."""
    refs = table(spark, sf_dir, "reference_manifest").filter("benchmark_split IS NOT NULL").groupBy("source_item_id").agg(F.min("benchmark_split").alias("benchmark_split"))
    items = _newest_items(spark, sf_dir).groupBy("source_item_id").agg(F.min("item_id").alias("item_id"), F.max(F.size(F.coalesce("exported_assets", F.array()))).alias("assets"))
    texts = table(spark, sf_dir, "documents").filter("item_id IS NOT NULL AND doc_kind = 'transcription'").groupBy("item_id").agg(F.min("doc_id").alias("transcription"))
    joined = refs.join(items, "source_item_id", "left").join(texts, "item_id", "left")
    return joined.select("source_item_id", "benchmark_split", "item_id", F.coalesce("assets", F.lit(0)).cast("long").alias("assets"), "transcription", F.col("transcription").isNotNull().alias("has_reference"))


_EXAMPLES = f"""
WITH {_NEWEST}, r AS (SELECT source_item_id, min(benchmark_split) AS benchmark_split FROM reference_manifest WHERE benchmark_split IS NOT NULL GROUP BY 1),
i AS (SELECT source_item_id, min(item_id) AS item_id, max(coalesce(len(exported_assets), 0)) AS assets FROM newest GROUP BY 1),
t AS (SELECT item_id, min(doc_id) AS transcription FROM documents WHERE item_id IS NOT NULL AND doc_kind = 'transcription' GROUP BY 1)
SELECT r.source_item_id, benchmark_split, i.item_id, coalesce(assets, 0) AS assets, transcription, transcription IS NOT NULL AS has_reference
FROM r LEFT JOIN i ON i.source_item_id = r.source_item_id LEFT JOIN t ON t.item_id = i.item_id"""


def example_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = examples(spark, sf_dir)
    return e.groupBy("benchmark_split").agg(F.count("*").alias("items"), F.count_if("has_reference").alias("with_reference"), F.sum("assets").alias("assets"))


def broken_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every link between tables that leads nowhere, counted by kind."""
    t = lambda name: table(spark, sf_dir, name)
    links = {
        "manifest_record": (t("reference_manifest"), "source_item_id", t("records"), "id"),
        "result_item": (t("rights_results"), "item_id", t("exported_items"), "item_id"),
        "result_license": (t("rights_results"), "normalized_license", t("licenses"), "id"),
        "item_license": (t("exported_items"), "normalized_license", t("licenses"), "id"),
        "document_item": (t("documents"), "item_id", t("exported_items"), "item_id"),
    }
    return validation.broken_links(links).groupBy("link").agg(F.count("*").alias("n"), F.countDistinct("value").alias("values"))


_BROKEN = " UNION ALL ".join(
    f"SELECT '{link}' AS link, count(*) AS n, count(DISTINCT {col}) AS \"values\" FROM {child} WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL) HAVING count(*) > 0"
    for link, child, col, parent, key in [
        ("manifest_record", "reference_manifest", "source_item_id", "records", "id"),
        ("result_item", "rights_results", "item_id", "exported_items", "item_id"),
        ("result_license", "rights_results", "normalized_license", "licenses", "id"),
        ("item_license", "exported_items", "normalized_license", "licenses", "id"),
        ("document_item", "documents", "item_id", "exported_items", "item_id"),
    ]
)


def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each reason against a captured page occurs, before pages are counted once."""
    from ledgerloom.plans.curation_queries import page_checks

    reasons = page_checks(spark, sf_dir).select(F.explode(F.split("reasons", ",")).alias("reason")).filter("reason <> ''")
    return reasons.groupBy("reason").agg(F.count("*").alias("n"))


def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold each kind of character."""
    docs = table(spark, sf_dir, "documents").select(*[c.alias(n) for n, c in tx.coverage(F.col("text")).items()])
    return aggregates.flag_counts(docs, docs.columns)


_COVERED = r"""
SELECT name, n FROM (UNPIVOT (SELECT count(*) FILTER (regexp_matches(text, '[\x{05D0}-\x{05EA}]')) AS letters, count(*) FILTER (regexp_matches(text, '[\x{05DA}\x{05DD}\x{05DF}\x{05E3}\x{05E5}]')) AS final_letters,
  count(*) FILTER (regexp_matches(text, '[\x{0591}-\x{05BD}\x{05BF}\x{05C1}\x{05C2}\x{05C4}\x{05C5}\x{05C7}]')) AS niqqud, count(*) FILTER (regexp_matches(text, '[0-9]')) AS numerals,
  count(*) FILTER (regexp_matches(text, '\p{P}')) AS punctuation, count(*) FILTER (regexp_matches(text, '[A-Za-z]')) AS latin FROM documents)
  ON letters, final_letters, niqqud, numerals, punctuation, latin INTO NAME name VALUE n)"""


def composition_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The synthetic part of the newest release by each of seven columns and by split, in one pass."""
    fields = ["content_class", "period_class", "language_class", "quality_tier", "normalized_license", "rights_classification", "source_id"]
    items = _newest_items(spark, sf_dir)
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("unknown")).alias("value")) for f in fields])).alias("p")
    long = items.select(F.coalesce("split", F.lit("none")).alias("split"), "is_synthetic", pairs).select("split", "is_synthetic", "p.*")
    rolled = long.groupingSets([[F.col("field"), F.col("value")], [F.col("split"), F.col("field"), F.col("value")]], F.col("split"), F.col("field"), F.col("value"))
    return rolled.agg(F.count("*").alias("n"), F.count_if("is_synthetic").alias("synthetic"), F.bround(F.count_if("is_synthetic") / F.count("*"), 6).alias("fraction")).select(F.coalesce("split", F.lit("all")).alias("split"), "field", "value", "n", "synthetic", "fraction")


_COMPOSED = f"""
WITH {_NEWEST}, l AS (SELECT coalesce(split, 'none') AS split, is_synthetic, unnest(['content_class', 'period_class', 'language_class', 'quality_tier', 'normalized_license', 'rights_classification', 'source_id']) AS field,
  unnest([coalesce(content_class, 'unknown'), coalesce(period_class, 'unknown'), coalesce(language_class, 'unknown'), coalesce(quality_tier, 'unknown'), coalesce(normalized_license, 'unknown'), coalesce(rights_classification, 'unknown'), coalesce(source_id, 'unknown')]) AS value FROM newest)
SELECT coalesce(split, 'all') AS split, field, value, count(*) AS n, count(*) FILTER (is_synthetic) AS synthetic, round_even(count(*) FILTER (is_synthetic) / count(*)::DOUBLE, 6) AS fraction
FROM l GROUP BY GROUPING SETS ((field, value), (split, field, value))"""


def kept_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published diffs cut down to the items of the newest release: what remains of each."""
    diffs = table(spark, sf_dir, "release_diffs")
    kept = nested.keep_members(diffs, "diff_id", "changed_items", "item_id", _newest_items(spark, sf_dir), "item_id")
    return kept.select("diff_id", F.size("changed_items").cast("long").alias("items"), F.array_join(F.transform("changed_items", lambda i: F.coalesce(i["item_id"], F.lit(""))), ",").alias("ids"))


_KEPT = f"""
WITH {_NEWEST}, m AS (SELECT diff_id, i, changed_items[i].item_id AS item_id FROM (SELECT diff_id, changed_items, unnest(range(1, len(changed_items) + 1)) AS i FROM release_diffs)),
k AS (SELECT diff_id, count(*) AS n, string_agg(item_id, ',' ORDER BY i) AS ids FROM m WHERE item_id IN (SELECT item_id FROM newest WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.diff_id, coalesce(n, 0) AS items, coalesce(ids, '') AS ids FROM release_diffs d LEFT JOIN k USING (diff_id)"""


def public_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset lists of the newest release without what looks like a path of one machine."""
    items = _newest_items(spark, sf_dir)
    clean = paths.without_local(F.col("exported_assets"), items.schema["exported_assets"].dataType)
    return items.select("item_id", F.array_join(F.transform(clean, lambda a: F.concat_ws(" ", a["release_asset_path"], a["release_preview_path"])), "|").alias("assets"))


_ASSETS = rf"""
WITH {_NEWEST} SELECT item_id, array_to_string(list_transform(exported_assets, lambda a: concat_ws(' ',
  CASE WHEN regexp_matches(a.release_asset_path, '^(https?|package)://') OR NOT regexp_matches(a.release_asset_path, '^(/|file://|\\\\|[A-Za-z]:[\\/])|\.work[/\\]') THEN a.release_asset_path END,
  CASE WHEN regexp_matches(a.release_preview_path, '^(https?|package)://') OR NOT regexp_matches(a.release_preview_path, '^(/|file://|\\\\|[A-Za-z]:[\\/])|\.work[/\\]') THEN a.release_preview_path END)), '|') AS assets FROM newest"""


def portable_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset paths of records by the variants of what counts as portable."""
    records = table(spark, sf_dir, "records").select(F.regexp_replace("asset_path", "^package://", "").alias("path")).distinct()
    return records.select("path", *[paths.is_portable(F.col("path"), **kw).alias(name) for name, kw in paths.VARIANTS.items()])


_PORTABLE = r"""
SELECT path, coalesce(NOT (base OR regexp_matches(path, '^[A-Za-z]:|^\s|\s$|(^|/)\.work(/|$)')), false) AS manifest, coalesce(NOT (base OR regexp_matches(path, '^.:')), false) AS batch,
  coalesce(NOT (base OR regexp_matches(path, '^[A-Za-z]:|^\s|\s$|^~')), false) AS intake
FROM (SELECT path, path = '' OR regexp_matches(path, '^/|\\|://|(^|/)\.\.(/|$)|^\.(/+\.)*/*$') AS base FROM (SELECT DISTINCT regexp_replace(asset_path, '^package://', '') AS path FROM records))"""


def asset_extensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored extensions by path, else by media type."""
    assets = table(spark, sf_dir, "exported_items").select(F.explode("exported_assets").alias("a"))
    # half of the paths lose their extension, so that the media type has to tell
    path = F.when(F.col("a.asset_format") == "png", F.regexp_replace("a.release_asset_path", r"\.[a-z]+$", "")).otherwise(F.col("a.release_asset_path"))
    return assets.select(paths.extension(path, F.col("a.media_type")).alias("extension"), F.col("a.media_type").alias("media_type")).groupBy("extension", "media_type").agg(F.count("*").alias("n"))


_EXTENSIONS = r"""
SELECT coalesce(CASE WHEN own IN ('jpg', 'png', 'tif', 'svg', 'webp', 'pdf', 'jpeg', 'tiff') THEN own END,
  CASE media_type WHEN 'image/jpeg' THEN 'jpg' WHEN 'image/png' THEN 'png' WHEN 'image/tiff' THEN 'tif' WHEN 'image/svg+xml' THEN 'svg' WHEN 'image/webp' THEN 'webp' WHEN 'application/pdf' THEN 'pdf' END) AS extension, media_type, count(*) AS n
FROM (SELECT a.media_type AS media_type, CASE WHEN a.asset_format <> 'png' THEN lower(regexp_extract(a.release_asset_path, '\.([A-Za-z0-9]+)$', 1)) END AS own FROM (SELECT unnest(exported_assets) AS a FROM exported_items)) GROUP BY 1, 2"""


def item_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items by the tuple of their assets' hashes: near duplicates if one signature has several ids."""
    items = _newest_items(spark, sf_dir)
    hashes = F.transform("exported_assets", lambda a: F.struct(F.sha2(F.element_at(F.split(a["release_asset_path"], "/"), -1), 256).alias("hash"), F.sha2(a["release_preview_path"], 256).alias("preview_hash")))
    signed = items.select("item_id", dedupe.item_signature(hashes).alias("signature"))
    return dedupe.shared_keys(signed, "signature", 1).groupBy("members").agg(F.count("*").alias("signatures"))


_ITEM_SIGNATURES = f"""
WITH {_NEWEST} SELECT members, count(*) AS signatures FROM (SELECT s, count(*) AS members FROM (
  SELECT list_transform(exported_assets, lambda a: coalesce(sha256(list_last(string_split(a.release_asset_path, '/'))), sha256(a.release_preview_path))) AS s FROM newest)
  WHERE len(s) > 0 AND len(s) = len(list_filter(s, lambda x: x IS NOT NULL)) GROUP BY 1) GROUP BY 1"""


def marked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages that hold a marker of a challenge, in title or description."""
    pages = table(spark, sf_dir, "seed_pages")
    markers = ["checking your browser", "enable javascript", "captcha", "access denied"]
    return pages.filter(tx.holds_any(F.concat_ws("\n", "title", "description"), markers)).select("page_id")


_MARKED = "SELECT page_id FROM seed_pages WHERE regexp_matches(lower(concat_ws(chr(10), title, description)), 'checking your browser|enable javascript|captcha|access denied')"


def text_normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by whether their text is in normal form C."""
    docs = table(spark, sf_dir, "documents").select(tx.is_nfc(F.col("text")).alias("nfc"))
    return docs.groupBy("nfc").agg(F.count("*").alias("n"))


def source_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by field of the newest release beside the one before: a report of two frames."""
    order = snapshots.snapshot_order(table(spark, sf_dir, "exported_items"), "release_version", "exported_at").select(F.col("snapshot").alias("release_version"), F.col("rank").alias("release_rank"))
    items = _current(spark, sf_dir).join(F.broadcast(order), "release_version")  # one row a release
    last = F.broadcast(order.agg(F.max("release_rank").alias("last")))
    of = lambda back: items.join(last, F.col("release_rank") == F.col("last") - back)
    return aggregates.count_deltas(of(0), of(1), ["split", "source_id"])


_SOURCE_CHANGES = f"""
WITH {_LATEST}, l AS (SELECT rnk, unnest(['split', 'source_id']) AS field, unnest([coalesce(split, 'unknown'), coalesce(source_id, 'unknown')]) AS value FROM latest JOIN ranked USING (release_version)),
m AS (SELECT max(rnk) AS m FROM ranked)
SELECT field, value, count(*) FILTER (rnk = m) AS "current", count(*) FILTER (rnk = m - 1) AS previous, count(*) FILTER (rnk = m) - count(*) FILTER (rnk = m - 1) AS delta
FROM l, m WHERE rnk >= m - 1 GROUP BY 1, 2"""


def item_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest item of each reference by item id, else by record; references without any are violations."""
    refs = table(spark, sf_dir, "reference_manifest").select("reference_id", "item_id", "source_item_id").distinct()
    items = _newest_items(spark, sf_dir).select(F.col("item_id").alias("by_item"), F.col("source_item_id").alias("by_record"), F.col("item_id").alias("found"))
    return joins.either_key(refs, items, [("item_id", "by_item"), ("source_item_id", "by_record")], "found").select("reference_id", "item_id", "source_item_id", "found")


_LOOKUP = f"""
WITH {_NEWEST}, a AS (SELECT item_id, min(item_id) AS f FROM newest GROUP BY 1), b AS (SELECT source_item_id, min(item_id) AS f FROM newest WHERE source_item_id IS NOT NULL GROUP BY 1)
SELECT r.reference_id, r.item_id, r.source_item_id, coalesce(a.f, b.f) AS found FROM (SELECT DISTINCT reference_id, item_id, source_item_id FROM reference_manifest) r
LEFT JOIN a ON a.item_id = r.item_id LEFT JOIN b ON b.source_item_id = r.source_item_id"""


def required_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rights results with and without the item that they need."""
    results = table(spark, sf_dir, "rights_results").filter("item_id IS NOT NULL").select("result_id", "item_id")
    known = table(spark, sf_dir, "exported_items").select("item_id").distinct()
    joined, misses = joins.required(results, known, ["item_id"])
    return joined.withColumn("state", F.lit("joined")).unionByName(misses.withColumn("state", F.lit("missing"))).groupBy("state").agg(F.count("*").alias("n"))


def restricted_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of equal documents, copy and kept one, both of items of the newest release."""
    from ledgerloom.plans.curation_queries import exact_dedupe_removed

    docs = table(spark, sf_dir, "documents").select("doc_id", "item_id")
    chosen = docs.join(_newest_items(spark, sf_dir).select("item_id"), "item_id", "left_semi")
    pairs = exact_dedupe_removed(spark, sf_dir).select("doc_id", "canonical")
    return releases.restrict({"pairs": (pairs, ["doc_id", "canonical"])}, chosen, "doc_id")["pairs"]


def _restricted_sql() -> str:
    from ledgerloom.plans.curation_queries import ORACLES as curation

    return f"""
WITH {_NEWEST}, chosen AS (SELECT doc_id FROM documents WHERE item_id IN (SELECT item_id FROM newest WHERE item_id IS NOT NULL))
SELECT doc_id, canonical FROM ({curation['exact_dedupe_removed']}) WHERE doc_id IN (FROM chosen) AND canonical IN (FROM chosen)"""


def source_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of the newest release of each source beside all that they ever had."""
    counts = _newest_items(spark, sf_dir).groupBy("source_id").agg(F.count("*").alias("n"))
    every = table(spark, sf_dir, "exported_items").filter("source_id IS NOT NULL").groupBy("source_id").agg(F.countDistinct("item_id").alias("target"))
    return releases.against_targets(counts, every, "source_id")


_TARGETS_MET = f"""
WITH {_NEWEST}, c AS (SELECT source_id, count(*) AS n FROM newest GROUP BY 1), t AS (SELECT source_id, count(DISTINCT item_id) AS target FROM exported_items WHERE source_id IS NOT NULL GROUP BY 1)
SELECT source_id, coalesce(n, 0) AS n, target, greatest(0, target - coalesce(n, 0)) AS gap, CASE WHEN coalesce(n, 0) = 0 THEN 'missing' WHEN target > n THEN 'short' ELSE 'met' END AS status FROM t LEFT JOIN c USING (source_id)"""


def unlisted_assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assets of earlier releases that the newest one has in no item, by path and type."""
    columns = ["release_asset_path", "media_type", "asset_format"]
    spread = lambda df: df.select(F.explode("exported_assets").alias("a")).select(*[F.col(f"a.{c}").alias(c) for c in columns])
    every, newest = spread(table(spark, sf_dir, "exported_items")).distinct(), spread(_newest_items(spark, sf_dir))
    return validation.unknown_rows(every, newest, columns).groupBy("asset_format").agg(F.count("*").alias("n"))


_UNLISTED = f"""
WITH {_NEWEST}, e AS (SELECT DISTINCT a.release_asset_path, a.media_type, a.asset_format FROM (SELECT unnest(exported_assets) AS a FROM exported_items)),
n AS (SELECT DISTINCT a.release_asset_path, a.media_type, a.asset_format FROM (SELECT unnest(exported_assets) AS a FROM newest))
SELECT asset_format, count(*) AS n FROM (FROM e EXCEPT FROM n) GROUP BY 1"""


def page_rights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captured pages by the standard form of their rights statement."""
    pages = table(spark, sf_dir, "seed_pages").select(rights.standard_form(F.col("rights"), "Any use permitted", ["any use", "any purpose", "כל שימוש"]).alias("statement"))
    return pages.groupBy("statement").agg(F.count("*").alias("n"))


_STATEMENTS = r"""
SELECT CASE WHEN regexp_matches(lower(s), 'any use|any purpose|כל שימוש') THEN 'Any use permitted' ELSE s END AS statement, count(*) AS n
FROM (SELECT nullif(regexp_replace(rights, '^[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+$', '', 'g'), '') AS s FROM seed_pages) GROUP BY 1"""


def template_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Generated candidates, one for each reference, that take the templates in turn."""
    n = table(spark, sf_dir, "reference_manifest").count()
    return selection.template_rows(spark, n, ["handwritten_note", "printed_letter", "ledger"])


_PAIRS = [
    (record_classes, _CLASSES),
    (item_quality, _QUALITY),
    (rights_normalised, _RIGHTS),
    (merged_decisions, _MERGED),
    (decision_progress, _PROGRESS),
    (reviewer_items, "SELECT reference_id, source_id, coalesce(bool_or(list_contains(reviewers, 'reviewer-15')) OVER (PARTITION BY reference_id), false) AS decided FROM reference_manifest QUALIFY row_number() OVER (PARTITION BY reference_id, source_id) = 1"),
    (set_overlaps, _OVERLAPS),
    (mismatched_references, _MISMATCHED),
    (decision_targets, _TARGETS),
    (holdout_risks, _RISKS),
    (split_precedence, _PRECEDENCE),
    (leakage_kinds, _KINDS),
    (release_baselines, "SELECT release_version, min(exported_at) AS exported_at FROM exported_items GROUP BY 1 ORDER BY 2 DESC NULLS LAST LIMIT 1"),
    (removal_reasons, _REMOVAL),
    (declared_counts, _DECLARED),
    (balanced_selection, _BALANCED),
    (split_listing, _LISTING),
    (reference_versions, _VERSIONS),
    (examples, _EXAMPLES),
    (example_summary, f"SELECT benchmark_split, count(*) AS items, count(*) FILTER (has_reference) AS with_reference, sum(assets)::BIGINT AS assets FROM ({_EXAMPLES}) GROUP BY 1"),
    (broken_references, _BROKEN),
    (reason_counts, None),
    (coverage_counts, _COVERED),
    (composition_all, _COMPOSED),
    (kept_changes, _KEPT),
    (public_assets, _ASSETS),
    (portable_paths, _PORTABLE),
    (asset_extensions, _EXTENSIONS),
    (item_signatures, _ITEM_SIGNATURES),
    (marked_pages, _MARKED),
    (text_normal_forms, "SELECT nfc_normalize(text) = text AS nfc, count(*) AS n FROM documents GROUP BY 1"),
    (source_changes, _SOURCE_CHANGES),
    (item_lookup, _LOOKUP),
    (template_listing, "SELECT 'synthetic-' || i AS source_item_id, CASE (i - 1) % 3 WHEN 0 THEN 'handwritten_note' WHEN 1 THEN 'printed_letter' ELSE 'ledger' END AS template_id FROM (SELECT unnest(range(1, (SELECT count(*) FROM reference_manifest) + 1)) AS i)"),
    (source_targets, _TARGETS_MET),
    (unlisted_assets, _UNLISTED),
    (page_rights, _STATEMENTS),
    (restricted_relations, None),
    (required_items, "SELECT CASE WHEN item_id IN (SELECT item_id FROM exported_items WHERE item_id IS NOT NULL) THEN 'joined' ELSE 'missing' END AS state, count(*) AS n FROM rights_results WHERE item_id IS NOT NULL GROUP BY 1"),
]


def _reason_sql() -> str:
    from ledgerloom.plans.curation_queries import ORACLES as curation

    return f"SELECT reason, count(*) AS n FROM (SELECT unnest(string_split(reasons, ',')) AS reason FROM ({curation['page_checks']})) WHERE reason <> '' GROUP BY 1"


QUERIES = {f.__name__: f for f, _ in _PAIRS}
ORACLES = {f.__name__: sql for f, sql in _PAIRS if sql} | {"reason_counts": _reason_sql(), "restricted_relations": _restricted_sql()}

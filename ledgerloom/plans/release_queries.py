"""Release reports, histories, projections, rules and scoring over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import text as tx
from ledgerloom.operators import aggregates, evaluation, history, joins, rules, snapshots, validation
from ledgerloom.storage import table


def _current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that counts of each (release, item): the latest arrival."""
    items = table(spark, sf_dir, "exported_items")
    return history.latest(items, ["release_version", "item_id"], [F.col("ingested_at").desc_nulls_last(), F.col("split"), F.col("title")])


_LATEST = """
latest AS (SELECT * FROM exported_items
  QUALIFY row_number() OVER (PARTITION BY release_version, item_id ORDER BY ingested_at DESC NULLS LAST, split NULLS FIRST, title NULLS FIRST) = 1),
ranked AS (SELECT release_version, row_number() OVER (ORDER BY min(exported_at)) AS rnk FROM exported_items GROUP BY 1)"""


def release_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = snapshots.snapshot_order(table(spark, sf_dir, "exported_items"), "release_version", "exported_at")
    return order.withColumn("rank", F.col("rank").cast("long"))


def release_source_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _current(spark, sf_dir).groupBy("release_version", "source_id").agg(
        F.count("*").alias("items"), F.count_if("is_synthetic").alias("synthetic"), F.countDistinct("split_group_id").alias("groups"), F.sum(F.size(F.coalesce("exported_assets", F.array()))).alias("assets")
    )


_SOURCE_STATS = f"""
WITH {_LATEST} SELECT release_version, source_id, count(*) AS items, count(*) FILTER (is_synthetic) AS synthetic,
  count(DISTINCT split_group_id) AS groups, sum(coalesce(len(exported_assets), 0))::BIGINT AS assets FROM latest GROUP BY 1, 2"""


def release_count_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by field value of each release beside those of the one before."""
    fields = ["split", "normalized_license", "quality_tier", "language_class"]
    order = snapshots.snapshot_order(table(spark, sf_dir, "exported_items"), "release_version", "exported_at").select(F.col("snapshot").alias("release_version"), "rank")
    items = _current(spark, sf_dir).join(F.broadcast(order), "release_version")  # one row a release
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.coalesce(F.col(f), F.lit("unknown")).alias("value")) for f in fields])).alias("p")
    counts = items.select("rank", pairs).groupBy("rank", "p.field", "p.value").agg(F.count("*").alias("n"))
    last = order.agg(F.max("rank").alias("last"))
    now = counts.select("rank", "field", "value", F.col("n").alias("current"))
    then = counts.select((F.col("rank") + 1).alias("rank"), "field", "value", F.col("n").alias("previous")).join(F.broadcast(last), F.col("rank") <= F.col("last")).drop("last")
    both = now.join(then, ["rank", "field", "value"], "full_outer").na.fill(0, ["current", "previous"])
    return both.filter("rank > 1").select(F.col("rank").cast("long").alias("rank"), "field", "value", "current", "previous", (F.col("current") - F.col("previous")).alias("delta"))


_DELTAS = f"""
WITH {_LATEST}, counts AS (SELECT rnk, field, value, count(*) AS n FROM (
  SELECT rnk, unnest(['split', 'normalized_license', 'quality_tier', 'language_class']) AS field,
    unnest([coalesce(split, 'unknown'), coalesce(normalized_license, 'unknown'), coalesce(quality_tier, 'unknown'), coalesce(language_class, 'unknown')]) AS value
  FROM latest JOIN ranked USING (release_version)) GROUP BY 1, 2, 3),
prev AS (SELECT rnk + 1 AS rnk, field, value, n FROM counts WHERE rnk < (SELECT max(rnk) FROM ranked))
SELECT coalesce(c.rnk, p.rnk) AS rank, coalesce(c.field, p.field) AS field, coalesce(c.value, p.value) AS value, coalesce(c.n, 0) AS "current", coalesce(p.n, 0) AS previous,
  coalesce(c.n, 0) - coalesce(p.n, 0) AS delta
FROM counts c FULL JOIN prev p ON c.rnk = p.rnk AND c.field = p.field AND c.value = p.value WHERE coalesce(c.rnk, p.rnk) > 1"""


def published_diff_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes that the published diffs list, by kind and pair of releases."""
    diffs = table(spark, sf_dir, "release_diffs")
    items = diffs.select("previous_version", "version", F.explode("changed_items").alias("i"))
    kinds = items.select("previous_version", "version", "i.item_id", F.explode("i.change_types").alias("change_type")).distinct()
    return kinds.groupBy("previous_version", "version", "change_type").agg(F.count("*").alias("n"))


_COVERAGE = """
SELECT previous_version, version, change_type, count(*) AS n FROM (
  SELECT DISTINCT previous_version, version, i.item_id AS item_id, unnest(i.change_types) AS change_type
  FROM (SELECT previous_version, version, unnest(changed_items) AS i FROM release_diffs)) GROUP BY 1, 2, 3"""


def composition_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [["release_version"], ["release_version", "split"], ["release_version", "content_class"], []]
    return aggregates.composition(_current(spark, sf_dir), sets, "is_synthetic")


_COMPOSITION = f"""
WITH {_LATEST} SELECT release_version, split, content_class, grouping(release_version, split, content_class) AS grouping, count(*) AS n,
  count(*) FILTER (is_synthetic) AS flagged, round_even(count(*) FILTER (is_synthetic) / count(*)::DOUBLE, 6) AS share
FROM latest GROUP BY GROUPING SETS ((release_version), (release_version, split), (release_version, content_class), ())"""


def capped_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best items of each release and kind: a top-k report."""
    order = [F.col("quality_score").desc_nulls_last(), F.col("item_id")]
    best = history.capped(_current(spark, sf_dir), ["release_version", "is_synthetic"], order, 50)
    return best.select("release_version", "is_synthetic", "item_id", F.col("rank").cast("long").alias("rank"))


_CAPPED = f"""
WITH {_LATEST} SELECT release_version, is_synthetic, item_id, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY release_version, is_synthetic ORDER BY quality_score DESC NULLS LAST, item_id) AS rank FROM latest) WHERE rank <= 50"""


def latest_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest capture of each seed, with how often it was captured."""
    pages = table(spark, sf_dir, "seed_pages")
    newest = history.latest(pages, ["seed_id"], [F.col("captured_at").desc_nulls_last(), F.col("page_id")])
    counts = pages.groupBy("seed_id").agg(F.count("*").alias("captures"), F.min("captured_at").alias("first_at"))
    return newest.select("seed_id", "page_id", "captured_at").join(counts, "seed_id")


_CAPTURE = """
SELECT n.seed_id, n.page_id, n.captured_at, c.captures, c.first_at FROM (
  SELECT * FROM seed_pages QUALIFY row_number() OVER (PARTITION BY seed_id ORDER BY captured_at DESC NULLS LAST, page_id) = 1) n
JOIN (SELECT seed_id, count(*) AS captures, min(captured_at) AS first_at FROM seed_pages GROUP BY 1) c USING (seed_id)"""


def redelivered_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures that came again under another page id."""
    pages = table(spark, sf_dir, "seed_pages")
    grouped = pages.groupBy("seed_id", "captured_at", F.xxhash64("title", "description", "rights", "asset_urls").alias("h"), "title", "description", "rights", "asset_urls")
    twice = grouped.agg(F.count("*").alias("deliveries"), F.min("page_id").alias("kept")).filter("deliveries > 1")
    return twice.select("seed_id", "captured_at", "deliveries", "kept")


_REDELIVERED = """
SELECT seed_id, captured_at, count(*) AS deliveries, min(page_id) AS kept FROM seed_pages
GROUP BY seed_id, captured_at, title, description, rights, asset_urls HAVING count(*) > 1"""


def decision_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rights results as a table kept by upsert: the last decision on each item wins."""
    results = table(spark, sf_dir, "rights_results").filter("item_id IS NOT NULL")
    seconds = F.col("decided_at").cast("timestamp").cast("double")
    cut = results.agg(((F.min(seconds) + F.max(seconds)) / 2).alias("cut"))
    marked = results.filter("decided_at IS NOT NULL").join(F.broadcast(cut), F.lit(True)).withColumn("late", seconds > F.col("cut"))  # one row
    newest = [F.col("decided_at").desc(), F.col("result_id")]
    early, late = (history.latest(marked.filter(side), ["item_id"], newest).drop("cut", "late") for side in (~F.col("late"), F.col("late")))
    return history.upsert(early, late, ["item_id"], "decided_at").select("item_id", "result_id", "decided_at")


_UPSERT = """
SELECT item_id, result_id, decided_at FROM rights_results WHERE item_id IS NOT NULL AND decided_at IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY decided_at DESC, result_id) = 1"""


def decision_at_creation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each document the rights result that held when it was made: an as-of join."""
    docs = table(spark, sf_dir, "documents").filter("item_id IS NOT NULL AND created_at IS NOT NULL").select("doc_id", "item_id", "created_at")
    results = table(spark, sf_dir, "rights_results").filter("item_id IS NOT NULL AND decided_at IS NOT NULL")
    states = results.groupBy("item_id", "decided_at").agg(F.max("result_id").alias("result_id"))
    return joins.range_lookup(docs, "item_id", "created_at", states, "decided_at", ["result_id"]).select("doc_id", "result_id")


_ASOF = """
SELECT d.doc_id, r.result_id FROM (SELECT * FROM documents WHERE item_id IS NOT NULL AND created_at IS NOT NULL) d ASOF LEFT JOIN (
  SELECT item_id, decided_at, max(result_id) AS result_id FROM rights_results WHERE item_id IS NOT NULL AND decided_at IS NOT NULL GROUP BY 1, 2) r
ON d.item_id = r.item_id AND d.created_at >= r.decided_at"""


def license_alias_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rights texts that are an id, name or alias apart from case and outer white space; the first entry wins."""
    results = table(spark, sf_dir, "rights_results").select("result_id", "raw_text")
    dim = table(spark, sf_dir, "licenses").withColumnRenamed("id", "license_id")
    labels = F.transform(F.concat(F.array("license_id", "name"), F.coalesce("aliases", F.array())), lambda x: tx.fold(x))
    matched = joins.first_match(results, tx.fold(F.col("raw_text")), dim, labels, "ord", "license_id")
    return matched.select("result_id", "license_id")


_ALIAS = r"""
SELECT r.result_id, m.id AS license_id FROM rights_results r LEFT JOIN (
  SELECT label, arg_min(id, ord) AS id FROM (SELECT id, ord, unnest(list_concat([id, name], aliases)) AS raw, lower(regexp_replace(raw, '^\s+|\s+$', '', 'g')) AS label FROM licenses)
  WHERE raw IS NOT NULL GROUP BY 1) m ON m.label = lower(regexp_replace(r.raw_text, '^[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+|[\s\x{00A0}\x{2000}-\x{200A}\x{3000}]+$', '', 'g'))"""


def asset_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    assets = _current(spark, sf_dir).select("release_version", "split", F.explode("exported_assets").alias("a"))
    return assets.groupBy("release_version", F.coalesce("split", F.lit("none")).alias("split"), "a.asset_format", "a.media_type").agg(
        F.count("*").alias("n"), F.count("a.release_preview_path").alias("previews")
    )


_FORMATS = f"""
WITH {_LATEST} SELECT release_version, coalesce(split, 'none') AS split, a.asset_format AS asset_format, a.media_type AS media_type, count(*) AS n, count(a.release_preview_path) AS previews
FROM (SELECT release_version, split, unnest(exported_assets) AS a FROM latest) GROUP BY 1, 2, 3, 4"""


def asset_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Asset addresses of a page in order, with name and extension of the stored file."""
    pages = table(spark, sf_dir, "seed_pages").select("page_id", F.posexplode(F.coalesce("asset_urls", F.array())).alias("at", "url"))
    name = F.format_string("asset_%02d", F.col("at") + 1)
    return pages.select("page_id", F.col("at").cast("long").alias("at"), "url", F.concat(name, F.lit("."), F.coalesce(F.nullif(tx.url_extension(F.col("url")), F.lit("")), F.lit("bin"))).alias("file"))


_POSITIONS = r"""
SELECT page_id, i - 1 AS at, asset_urls[i] AS url, printf('asset_%02d', i) || '.' || coalesce(nullif(lower(regexp_extract(asset_urls[i], '\.([A-Za-z0-9]{1,5})(?:[?#].*)?$', 1)), ''), 'bin') AS file
FROM (SELECT page_id, asset_urls, unnest(range(1, coalesce(len(asset_urls), 0) + 1)) AS i FROM seed_pages)"""


def public_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as they may be shown: no private columns, no paths of one machine."""
    records = table(spark, sf_dir, "records").drop("delivered_at", "f1_source_depth_only")
    path = F.when(~tx.looks_local(F.col("asset_path")), F.col("asset_path"))
    return records.withColumns({"asset_path": path, "portable": tx.is_portable_path(F.regexp_replace("asset_path", "^package://", ""))}).distinct()


_PUBLIC = r"""
SELECT DISTINCT id, title, source_url, upstream_identifier, collection, period, raw_rights,
  CASE WHEN NOT coalesce(NOT regexp_matches(asset_path, '^(https?|package)://') AND regexp_matches(asset_path, '^(/|file://|\\\\|[A-Za-z]:[\\/])|\.work[/\\]'), false) THEN asset_path END AS asset_path,
  coalesce(NOT regexp_matches(regexp_replace(asset_path, '^package://', ''), '^\s*$|^[/~]|\\|^[A-Za-z]:|(^|/)\.\.?(/|$)|//|^\s|\s$|^[A-Za-z][A-Za-z0-9+.-]*://'), false) AS portable
FROM records"""


def text_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What kinds of characters each document holds, and its script."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.script_class(F.col("text")).alias("script"), *[c.alias(n) for n, c in tx.coverage(F.col("text")).items()], tx.stable_id("doc", F.col("text")).alias("text_id"))


_FEATURES = r"""
SELECT doc_id, CASE WHEN h AND l THEN 'mixed' WHEN h THEN 'hebrew' WHEN l THEN 'latin' ELSE 'other' END AS script,
  coalesce(regexp_matches(text, '[\x{05D0}-\x{05EA}]'), false) AS letters, coalesce(regexp_matches(text, '[\x{05DA}\x{05DD}\x{05DF}\x{05E3}\x{05E5}]'), false) AS final_letters,
  coalesce(regexp_matches(text, '[\x{0591}-\x{05BD}\x{05BF}\x{05C1}\x{05C2}\x{05C4}\x{05C5}\x{05C7}]'), false) AS niqqud, coalesce(regexp_matches(text, '[0-9]'), false) AS numerals,
  coalesce(regexp_matches(text, '\p{P}'), false) AS punctuation, l AS latin, 'doc:' || substr(sha256(text), 1, 16) AS text_id
FROM (SELECT doc_id, text, coalesce(regexp_matches(text, '[\x{0590}-\x{05FF}]'), false) AS h, coalesce(regexp_matches(text, '[A-Za-z]'), false) AS l FROM documents)"""


def page_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Escaped titles, file names and the first text a page has to show."""
    pages = table(spark, sf_dir, "seed_pages")
    blank = lambda c: F.nullif(F.trim(c), F.lit(""))
    return pages.select(
        "page_id",
        tx.escape_html(F.col("title")).alias("escaped"),
        tx.safe_name(F.col("seed_id")).alias("file"),
        F.coalesce(blank("title"), blank("description"), blank("rights")).alias("label"),
        tx.url_host(F.col("source_url")).alias("host"),
    )


_STRINGS = r"""
SELECT page_id, replace(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS escaped,
  regexp_replace(seed_id, '[^A-Za-z0-9._-]', '_', 'g') AS file,
  coalesce(nullif(trim(title, ' '), ''), nullif(trim(description, ' '), ''), nullif(trim(rights, ' '), '')) AS label,
  lower(regexp_extract(source_url, '^[a-zA-Z]+://([^/?#]+)', 1)) AS host
FROM seed_pages"""

RULES = [
    rules.Rule("contact", 2, (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}",), ("text",)),
    rules.Rule("people", 1, (r"\b(widow|orphan|tenant)s?\b", "אלמנה|יתום"), ("text",)),
    rules.Rule("medical", 1, (r"\b(hospital|doctor)\b", "רופא"), ("text",)),
    rules.Rule("marked", 3, (r"^\[(approve|reject|defer)\]",), ("text",), case_sensitive=True),
]


def rule_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.apply_rules(docs, RULES).select("doc_id", F.array_join("matched", ",").alias("matched"), F.col("severity").cast("long").alias("severity"))


def rule_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rules.apply_rules(table(spark, sf_dir, "documents").select("source", "text"), RULES)
    return docs.select("source", F.explode("matched").alias("rule")).groupBy("source", "rule").agg(F.count("*").alias("n"))


_RULES = r"""
(SELECT doc_id, source, coalesce(regexp_matches(text, '(?i)[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'), false) AS contact,
  coalesce(regexp_matches(text, '(?i)\b(widow|orphan|tenant)s?\b') OR regexp_matches(text, 'אלמנה|יתום'), false) AS people,
  coalesce(regexp_matches(text, '(?i)\b(hospital|doctor)\b') OR regexp_matches(text, 'רופא'), false) AS medical,
  coalesce(regexp_matches(text, '^\[(approve|reject|defer)\]'), false) AS marked FROM documents)"""
_RULE_SCAN = f"""
SELECT doc_id, array_to_string(list_sort(list_filter([CASE WHEN contact THEN 'contact' END, CASE WHEN people THEN 'people' END, CASE WHEN medical THEN 'medical' END,
  CASE WHEN marked THEN 'marked' END], lambda x: x IS NOT NULL)), ',') AS matched, greatest(0, CASE WHEN contact THEN 2 ELSE 0 END, CASE WHEN people THEN 1 ELSE 0 END,
  CASE WHEN medical THEN 1 ELSE 0 END, CASE WHEN marked THEN 3 ELSE 0 END)::BIGINT AS severity FROM {_RULES}"""
_RULE_STATS = f"""
SELECT source, rule, count(*) AS n FROM (SELECT source, unnest(list_filter([CASE WHEN contact THEN 'contact' END, CASE WHEN people THEN 'people' END,
  CASE WHEN medical THEN 'medical' END, CASE WHEN marked THEN 'marked' END], lambda x: x IS NOT NULL)) AS rule FROM {_RULES}) GROUP BY 1, 2"""


def _titles(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Titles of each seed's first and last capture, as prediction and reference."""
    pages = table(spark, sf_dir, "seed_pages")
    ends = pages.groupBy("seed_id").agg(
        F.min_by("title", F.struct("captured_at", "page_id")).alias("first"), F.max_by("title", F.struct("captured_at", "page_id")).alias("last")
    )
    p = ends.filter("first IS NOT NULL").select(F.col("seed_id").alias("item_id"), F.col("first").alias("text"))
    r = ends.filter("last IS NOT NULL").select(F.col("seed_id").alias("item_id"), F.col("last").alias("text"))
    return ends.select(F.col("seed_id").alias("item_id")), p, r


def title_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.score_pairs(*_titles(spark, sf_dir))


def title_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.corpus_metrics(title_scores(spark, sf_dir))


def _signs(df: DataFrame) -> DataFrame:
    """Each foreign character as one sign, so that distances are the same in bytes and in characters."""
    return df.withColumn("text", F.regexp_replace("text", r"[^\x00-\x7F]", "?"))


def sign_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    examples, p, r = _titles(spark, sf_dir)
    return evaluation.score_pairs(examples, _signs(p), _signs(r))


_SIGNS = r"""
SELECT item_id, CASE WHEN p IS NULL THEN 'no_prediction' WHEN r IS NULL THEN 'no_reference' ELSE 'scored' END AS status,
  levenshtein(p, r)::INT AS distance, CASE WHEN p IS NOT NULL THEN length(r)::INT END AS length, p = r AS exact
FROM (SELECT item_id, regexp_replace(p, '[^\x00-\x7F]', '?', 'g') AS p, regexp_replace(r, '[^\x00-\x7F]', '?', 'g') AS r FROM {ends})"""


def sign_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report over seeds with a first title, so that some predictions and references are unexpected."""
    examples, p, r = _titles(spark, sf_dir)
    return evaluation.report(examples.join(p.filter("text <> ''").select("item_id"), "item_id", "left_semi"), _signs(p), _signs(r))


_REPORT = """
WITH e AS (SELECT * FROM ({signs}) s SEMI JOIN (SELECT item_id FROM {ends} WHERE p <> '') x USING (item_id)), n AS (SELECT item_id FROM e)
SELECT count(*) AS examples, count(*) FILTER (status = 'scored') AS scored, count(*) FILTER (status = 'no_reference') AS missing_references,
  round_even(sum(distance) / sum(length)::DOUBLE, 6) AS error_rate, round_even(count(*) FILTER (exact) / (count(*) FILTER (status = 'scored'))::DOUBLE, 6) AS exact_rate,
  round_even(count(*) FILTER (status = 'scored') / count(*)::DOUBLE, 6) AS coverage,
  (SELECT count(*) FROM {ends} WHERE p IS NOT NULL AND item_id NOT IN (FROM n)) AS unexpected_predictions, (SELECT count(*) FROM {ends} WHERE r IS NOT NULL AND item_id NOT IN (FROM n)) AS unexpected_references,
  count(*) > 0 AND count(*) = count(*) FILTER (status = 'scored') AND sum(length) > 0
    AND (SELECT count(*) FROM {ends} WHERE (p IS NOT NULL OR r IS NOT NULL) AND item_id NOT IN (FROM n)) = 0 AS ready FROM e"""


def checksum_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of one id in two deliveries of a page: the first against the last by digest."""
    _, p, r = _titles(spark, sf_dir)
    digest = lambda df: df.select("item_id", F.sha2("text", 256).alias("digest"))
    return validation.checksum_status(digest(p), digest(r), "item_id", "digest")


_ENDS = """(SELECT seed_id AS item_id, arg_min_null(title, row(captured_at, page_id)) AS p, arg_max_null(title, row(captured_at, page_id)) AS r FROM seed_pages GROUP BY 1)"""
_CHECKSUM = f"""
SELECT item_id, CASE WHEN r IS NULL THEN 'missing' WHEN p IS NULL THEN 'unexpected' WHEN p = r THEN 'ok' ELSE 'mismatch' END AS status
FROM {_ENDS} WHERE p IS NOT NULL OR r IS NOT NULL"""


def lang_by_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = aggregates.nested_counts(table(spark, sf_dir, "documents"), "doc_kind", "lang")
    return counts.select("doc_kind", F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",").alias("counts"))


_LANG = """
SELECT doc_kind, string_agg(lang || '=' || n, ',' ORDER BY lang) AS counts FROM (SELECT doc_kind, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY 1, 2) GROUP BY 1"""


def newest_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases in natural order of their names: numbers count by value."""
    names = table(spark, sf_dir, "exported_items").select("release_version").distinct()
    return names.select("release_version", tx.natural_key(F.col("release_version")).alias("key"))


_NATURAL = r"""
SELECT release_version, array_to_string(list_transform(regexp_extract_all(lower(release_version), '(\d+|\D+)'), lambda p: CASE WHEN NOT regexp_matches(p, '^\d') THEN p
  WHEN length(ltrim(p, '0')) <= 20 THEN lpad(ltrim(p, '0'), 20, '0') ELSE ':' || lpad(length(ltrim(p, '0'))::VARCHAR, 9, '0') || ltrim(p, '0') END), '') AS key
FROM (SELECT DISTINCT release_version FROM exported_items)"""


def events_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last write wins over the event stream's table: the newest event of each user and type."""
    events = table(spark, sf_dir, "events")
    return history.latest(events, ["user_id", "event_type"], [F.col("ts").desc(), F.col("event_id").desc()]).select("user_id", "event_type", "event_id", "value")


_PAIRS = [
    (release_order, "SELECT release_version AS snapshot, row_number() OVER (ORDER BY min(exported_at), release_version) AS rank, lag(release_version) OVER (ORDER BY min(exported_at), release_version) AS previous FROM exported_items GROUP BY 1"),
    (release_source_stats, _SOURCE_STATS),
    (release_count_deltas, _DELTAS),
    (published_diff_coverage, _COVERAGE),
    (composition_report, _COMPOSITION),
    (capped_selection, _CAPPED),
    (latest_capture, _CAPTURE),
    (redelivered_captures, _REDELIVERED),
    (decision_upsert, _UPSERT),
    (decision_at_creation, _ASOF),
    (license_alias_match, _ALIAS),
    (asset_formats, _FORMATS),
    (asset_positions, _POSITIONS),
    (public_projection, _PUBLIC),
    (text_features, _FEATURES),
    (page_strings, _STRINGS),
    (rule_scan, _RULE_SCAN),
    (rule_stats, _RULE_STATS),
    (title_scores, None),
    (title_metrics, None),
    (sign_scores, _SIGNS.format(ends=_ENDS)),
    (sign_report, _REPORT.format(ends=_ENDS, signs=_SIGNS.format(ends=_ENDS))),
    (checksum_status, _CHECKSUM),
    (lang_by_kind, _LANG),
    (newest_by_name, _NATURAL),
    (events_latest, "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1"),
]
QUERIES = {f.__name__: f for f, _ in _PAIRS}
ORACLES = {f.__name__: sql for f, sql in _PAIRS if sql}

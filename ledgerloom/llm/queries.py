"""The queries of this subpackage and, where SQL can state them, their comparison SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import canonical, encoding, garbled, grouped_splits, leakage, repeats, residue
from ledgerloom.storage import materialize, table

#: folder of the public tokenizers' files, the same on every worker
TOKENIZERS = os.environ.get("LEDGERLOOM_TOKENIZERS", "/opt/tokenizers")


_PAGE_TEXTS = ("title", "description", "rights")


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled.find(table(spark, sf_dir, "seed_pages"), "page_id", _PAGE_TEXTS)


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_restored(spark, sf_dir).select("page_id", "field").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = canonical.read_entries(table(spark, sf_dir, "licenses"), "ord", "id", "name", "aliases")
    records, results = table(spark, sf_dir, "records"), table(spark, sf_dir, "rights_results")
    sources = [
        (records.select(F.col("id").alias("row_key"), F.col("raw_rights").alias("value")), "records.raw_rights"),
        (results.select(F.col("result_id").cast("string").alias("row_key"), F.col("raw_text").alias("value")), "rights_results.raw_text"),
        (results.select(F.col("result_id").cast("string").alias("row_key"), F.col("normalized_license").alias("value")), "rights_results.normalized_license"),
    ]
    values = None
    for df, origin in sources:
        part = df.select(F.lit(origin).alias("origin"), "row_key", "value")
        values = part if values is None else values.unionByName(part)
    mapped = canonical.map_values(values, "value", ["origin", "row_key"], entries, "UNKNOWN")
    return mapped.select("origin", "row_key", F.col("entry_id").alias("license_id")).distinct()


def p4_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.find(table(spark, sf_dir, "seed_pages"), "page_id", ("title", "description"))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p4_scored(spark, sf_dir).select("page_id", "field").distinct()


def _record_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, manifest = table(spark, sf_dir, "records"), table(spark, sf_dir, "reference_manifest")

    def tie(kind: str, df: DataFrame, id_col: str, key) -> DataFrame:
        return df.select(F.concat(F.lit(kind), key).alias("key"), F.col(id_col).alias("id"))

    ties = (
        tie("w:", records, "id", grouped_splits.work_key(F.col("upstream_identifier")))
        .unionByName(tie("c:", records, "id", grouped_splits.collection_key(F.col("collection"))))
        .unionByName(tie("d:", manifest, "source_item_id", grouped_splits.deposit_key(F.col("source_id"))))
    )
    return grouped_splits.groups(records, ties)


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _record_groups(spark, sf_dir).filter("tied").select(F.col("id").alias("record_id"), "group_id")


def p5_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = materialize(_record_groups(spark, sf_dir).select("id", "group_id"), "groups")
    shares = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]
    return grouped_splits.assign(grouped, shares).withColumnRenamed("id", "record_id")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.encode(table(spark, sf_dir, "documents"), "doc_id", "text", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")


def p7_aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark_items"), "doc_id", "text", "eval_id", "text")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leakage.leaked(p7_aligned(spark, sf_dir))


def p7_edited(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark_items")
    return leakage.edited(leakage.find(documents, items, "doc_id", "text", "eval_id", "text", leakage.EDITED_WORDS))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes, spans, _ = repeats.shared_spans(table(spark, sf_dir, "documents"), "doc_id", "text")
    return repeats.pairs(classes, spans)


def p8_shared(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    share = repeats.shared_share(documents, "doc_id", "text", *repeats.shared_spans(documents, "doc_id", "text"))
    return share.withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_restored, p3_found, p4_found, p4_scored, p5_found, p5_splits, p6_ids, p7_found, p7_aligned, p7_edited, p8_found, p8_shared)}

_PLAIN = "trim(regexp_replace(translate(lower(regexp_replace({0}, '[\\x{{0300}}-\\x{{036F}}]', '', 'g')), 'áàâäãåāéèêëēíìîïīóòôöõøōúùûüūýÿñçšžčřßłđ', 'aaaaaaaeeeeeiiiiiooooooouuuuuyyncszcrsld'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ')"


def _listed(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


#: ties by keys, and their transitive closure: for tables of a test's size
_GROUPS = rf"""
WITH RECURSIVE w AS (SELECT id, upper(trim(upstream_identifier, ' ')) AS t, {_PLAIN.format("upstream_identifier")} AS plain FROM records),
c AS (SELECT id, {_PLAIN.format("collection")} AS whole,
  {_PLAIN.format("replace(regexp_replace(regexp_replace(regexp_replace(collection, '\\s*\\([^()]*\\)[\\s.]*$', ''), '^[^:/]*:', ''), '/.*$', ''), '&', ' and ')")} AS own FROM records),
d AS (SELECT source_item_id AS id, {_PLAIN.format("source_id")} AS plain FROM reference_manifest),
ties AS MATERIALIZED (SELECT DISTINCT key, id FROM (
  SELECT 'w:' || CASE WHEN regexp_matches(t, '^\s*(\p{{L}}+)[\s._-]*0*(\d+)') THEN regexp_extract(t, '^\s*(\p{{L}}+)[\s._-]*0*(\d+)', 1) || '-' || regexp_extract(t, '^\s*(\p{{L}}+)[\s._-]*0*(\d+)', 2)
    WHEN plain NOT IN {_listed(grouped_splits.NO_WORK)} THEN plain END AS key, id FROM w
  UNION ALL SELECT 'c:' || own, id FROM c WHERE whole NOT IN {_listed(grouped_splits.NO_COLLECTION)} AND own NOT IN {_listed(grouped_splits.NO_COLLECTION)}
  UNION ALL SELECT 'd:' || plain, id FROM d WHERE plain NOT IN {_listed(grouped_splits.NO_WORK)} AND id IN (SELECT id FROM records)) WHERE key IS NOT NULL AND id IS NOT NULL),
stars AS MATERIALIZED (SELECT DISTINCT t.id AS a, m.b FROM ties t JOIN (SELECT key, min(id) AS b FROM ties GROUP BY 1 HAVING min(id) < max(id)) m USING (key)),
reached AS (SELECT a AS id, a AS g FROM stars UNION SELECT b, b FROM stars
  UNION SELECT e.y, r.g FROM reached r JOIN (SELECT a AS x, b AS y FROM stars UNION SELECT b, a FROM stars) e ON e.x = r.id)
SELECT id AS record_id, min(g) AS group_id FROM reached GROUP BY 1"""

_WORDS = r"""
SELECT {id} AS id, regexp_extract_all(replace(replace(lower(regexp_replace(regexp_replace(regexp_replace({text}, '</?[A-Za-z][^<>]*>|<!--(.|\n)*?-->', ' ', 'g'),
  '&(#\d+|#[xX][0-9A-Fa-f]+|[A-Za-z][A-Za-z0-9]*);', ' ', 'g'), '[\x{0591}-\x{05BD}\x{05BF}\x{05C1}\x{05C2}\x{05C4}\x{05C5}\x{05C7}]', '', 'g')), 'ß', 'ss'), 'ς', 'σ'), '[\p{L}\p{N}]+') AS w FROM {table} WHERE {text} IS NOT NULL"""
_LEAKED = rf"""
WITH d AS ({_WORDS.replace("{id}", "doc_id").replace("{text}", "text").replace("{table}", "documents")}),
e AS ({_WORDS.replace("{id}", "eval_id").replace("{text}", "text").replace("{table}", "benchmark_items")}),
dg AS (SELECT DISTINCT id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 10)) AS i FROM d)),
eg AS (SELECT DISTINCT id, array_to_string(w[i:i + 11], ' ') AS g FROM (SELECT id, w, unnest(range(1, len(w) - 10)) AS i FROM e))
SELECT DISTINCT dg.id AS doc_id, eg.id AS eval_id FROM dg JOIN eg USING (g)"""

#: every window of 300 characters: for tables of a test's size
_SHARED = """
WITH w AS (SELECT DISTINCT doc_id, md5(substring(text, i, 300)) AS h FROM (SELECT doc_id, text, unnest(range(1, length(text) - 298)) AS i FROM documents WHERE length(text) >= 300)),
m AS (SELECT h FROM w GROUP BY 1 HAVING count(*) > 1), s AS MATERIALIZED (SELECT doc_id, h FROM w SEMI JOIN m USING (h))
SELECT DISTINCT a.doc_id AS doc_a, b.doc_id AS doc_b FROM s a JOIN s b ON a.h = b.h AND a.doc_id < b.doc_id"""

ORACLES: dict[str, str] = {"p5_found": _GROUPS, "p7_found": _LEAKED, "p8_found": _SHARED}

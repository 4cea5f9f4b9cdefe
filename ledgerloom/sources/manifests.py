"""Readers of manifests and record files that must have a given shape, and the checks of batch manifests.

A violation is a row. The ``strict`` readers raise before any row is used.
"""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.paths import VARIANTS, is_portable
from ledgerloom.functions.text import coverage, is_nfc, strip
from ledgerloom.operators.nested import uncovered
from ledgerloom.operators.validation import duplicate_keys
from ledgerloom.sources.readers import images

#: violations named in an error
NAMED = 5


class ShapeError(ValueError):
    """A file that isn't as it must be; the message names its first violations."""


def _stop_at(violations: DataFrame, what: str) -> None:
    first = violations.limit(NAMED).collect()
    if first:
        raise ShapeError(f"{what}: " + "; ".join(", ".join(str(v) for v in r) for r in first))


def _raw_records(spark: SparkSession, path: str) -> DataFrame:
    """(record) as JSON text: lines of a JSON-lines file, elements of a JSON list or of ``{"items": [...]}``; a null one if the file is neither."""
    if path.endswith((".jsonl", ".ndjson")):
        return spark.read.text(path).filter(F.trim("value") != "").select(F.col("value").alias("record"))
    raw = spark.read.text(path, wholetext=True)
    is_list = F.substring(F.ltrim("value"), 1, 1) == "["
    items = F.from_json("value", "struct<items: array<string>>").getField("items")
    listed = F.when(is_list, F.from_json("value", "array<string>")).otherwise(items)
    return raw.select(F.explode(F.coalesce(listed, F.array(F.lit(None).cast("string")))).alias("record"))


def _typed(v: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant")) == "STRING"


def text_record_violations(spark: SparkSession, path: str, value_field: str = "text") -> DataFrame:
    """(record, reason): records that are no object, lack an id or text of the right type, or repeat an id."""
    raw = _raw_records(spark, path).withColumn("v", F.try_parse_json("record"))
    ok = lambda c: F.coalesce(c, F.lit(False))
    item = F.try_variant_get("v", "$.item_id", "string")
    reason = (
        F.when(~ok(F.schema_of_variant("v").startswith("OBJECT")), "not an object")
        .when(~ok(_typed(F.col("v"), "item_id") & (item != "")), "no item_id")
        .when(~ok(_typed(F.col("v"), value_field)), f"no {value_field}")
    )
    marked = raw.select(F.substring("record", 1, 80).alias("record"), item.alias("item_id"), reason.alias("reason"))
    twice = duplicate_keys(marked.filter("reason IS NULL"), ["item_id"]).select(F.col("item_id").alias("record"), F.lit("duplicate item_id").alias("reason"))
    return marked.filter("reason IS NOT NULL").select("record", "reason").unionByName(twice)


def strict_text_records(spark: SparkSession, path: str, value_field: str = "text") -> DataFrame:
    """(item_id, text), each id once; raises :class:`ShapeError` for a file that has anything else."""
    _stop_at(text_record_violations(spark, path, value_field), path)
    v = F.parse_json("record")
    return _raw_records(spark, path).select(F.variant_get(v, "$.item_id", "string").alias("item_id"), F.variant_get(v, f"$.{value_field}", "string").alias("text"))


def listed(spark: SparkSession, path: str, field: str, schema: T.StructType, key: str | None = None) -> DataFrame:
    """Rows of the list under ``field`` of a manifest; raises if there is no such list or if ``key`` repeats."""
    wrapped = T.StructType([T.StructField(field, T.ArrayType(schema))])
    docs = spark.read.schema(wrapped).json(path, multiLine=True, mode="FAILFAST")
    _stop_at(docs.filter(F.col(field).isNull()).select(F.lit(f"no list {field}")), path)
    rows = docs.select(F.explode(field).alias("r")).select("r.*")
    if key is not None:
        _stop_at(duplicate_keys(rows, [key]), f"{path}: duplicate {key}")
    return rows


def record_folder(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """One row for each JSON file of a folder, with its name; a folder that isn't there is an empty one."""
    full = T.StructType([T.StructField("file", T.StringType()), *schema.fields])
    try:
        docs = spark.read.schema(schema).json(f"{folder}/*.json", multiLine=True, mode="FAILFAST")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)
    return docs.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), *schema.fieldNames())


def yaml_folder(spark: SparkSession, folder: str, key: str, schema: T.StructType) -> DataFrame:
    """One row for each small YAML file of a folder, by name; raises if there is none or if ``key`` repeats."""
    import yaml

    seen: dict[str, str] = {}
    rows = []
    for file in sorted(Path(folder).glob("*.yaml")):
        try:
            loaded = yaml.safe_load(file.read_text(encoding="utf-8")) or {}
        except yaml.YAMLError as e:
            raise ShapeError(f"{file}: {e}") from e
        if loaded.get(key) in seen:
            raise ShapeError(f"{file}: {key} {loaded.get(key)!r} is already in {seen[loaded.get(key)]}")
        seen[loaded.get(key)] = str(file)
        rows.append((file.name, *[loaded.get(n) for n in schema.fieldNames()]))
    if not rows:
        raise ShapeError(f"{folder}: no files")
    return spark.createDataFrame(rows, T.StructType([T.StructField("file", T.StringType()), *schema.fields]))


def corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line): the lines of a text corpus, stripped, without blank ones."""
    return spark.read.text(path).select(strip(F.col("value")).alias("line")).filter("line <> ''")


#: fixed values: the form of a batch manifest
BATCH = (
    "manifest_version string, generator_name string, provider_metadata map<string, string>, license string, synthetic_disclosure string, samples array<struct<"
    "sample_id: string, pages: array<struct<page_id: string, asset_path: string, media_type: string, sha256: string, width: int, height: int>>,"
    "text: struct<logical_order: string, script: string, language: string, direction: string, unicode_normalization: string>,"
    "rendering_metadata: struct<layout_family: string, line_count: int>, hebrew_coverage: map<string, boolean>, generator_version: string, recipe_id: string,"
    "provenance: struct<seed: long, sample_index: long, template_id: string, recipe_id: string, degradation_preset: string, font_id: string, source_corpus: string>,"
    "license: string, synthetic_disclosure: string, controls: map<string, string>>>"
)
#: fixed values: the names of ``coverage`` in manifests, and those that a batch must have somewhere
COVERAGE = {"letters": "has_hebrew_letters", "final_letters": "has_final_letters", "niqqud": "has_niqqud", "numerals": "has_arabic_numerals", "punctuation": "has_punctuation", "latin": "has_mixed_ltr"}
REQUIRED = ("has_arabic_numerals", "has_final_letters", "has_hebrew_letters", "has_punctuation")


def batch_samples(spark: SparkSession, path: str) -> DataFrame:
    """The samples of a batch manifest, with its version and provider."""
    docs = spark.read.schema(BATCH).json(path, multiLine=True, mode="FAILFAST")
    return docs.select("manifest_version", "provider_metadata", F.explode("samples").alias("s")).select("manifest_version", "provider_metadata", "s.*")


def batch_metadata(samples: DataFrame) -> DataFrame:
    """(sample_id, title, metadata): what items keep of samples; the text itself only as a hash and a first line."""
    text = F.col("text.logical_order")
    lines = F.split(text, "\r\n|\r|\n")
    keep = {
        "sample_id": F.col("sample_id"),
        "text_sha256": F.sha2(text, 256),
        "recipe_id": F.col("provenance.recipe_id"),
        "template_id": F.col("provenance.template_id"),
        "degradation_preset": F.col("provenance.degradation_preset"),
        "font_id": F.col("provenance.font_id"),
        "source_corpus": F.col("provenance.source_corpus"),
        "seed": F.col("provenance.seed").cast("string"),
        "sample_index": F.col("provenance.sample_index").cast("string"),
        "layout_family": F.col("rendering_metadata.layout_family"),
        "generator_version": F.col("generator_version"),
        "provider_version": F.col("provider_metadata")["provider_version"],
        "license": F.col("license"),
        "disclosure": F.col("synthetic_disclosure"),
        "manifest_version": F.col("manifest_version"),
    }
    title = F.coalesce(F.nullif(strip(lines.getItem(0)), F.lit("")), F.col("sample_id"))
    return samples.select("sample_id", title.alias("title"), F.map_filter(F.create_map(*[x for n, c in keep.items() for x in (F.lit(n), c)]), lambda k, v: v.isNotNull()).alias("metadata"))


def _repeated(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = None
    for c in columns:
        part = duplicate_keys(rows.filter(F.col(c).isNotNull()), [c]).select(F.col(c).cast("string").alias("part"), F.lit(f"duplicate {c}").alias("reason"))
        out = part if out is None else out.unionByName(part)
    return out


def batch_violations(spark: SparkSession, root: str, name: str = "manifest.json") -> DataFrame:
    """(part, reason) of a batch folder: repeated ids, samples that contradict themselves, pages unlike their files, kinds of text that are missing."""
    samples = batch_samples(spark, f"{root}/{name}")
    pages = samples.select("sample_id", F.explode("pages").alias("p")).select("sample_id", "p.*")
    out = _repeated(samples.select("sample_id", F.col("provenance.sample_index").alias("sample_index")), ["sample_id", "sample_index"]).unionByName(_repeated(pages, ["page_id", "asset_path"]))

    text = F.col("text.logical_order")
    lines = F.size(F.split(F.regexp_replace(text, "(\r\n|\r|\n)$", ""), "\r\n|\r|\n"))
    told = F.array(*[F.coalesce(F.col("hebrew_coverage")[n], F.lit(False)) for n in COVERAGE.values()])
    seen = coverage(text)
    fine = lambda c: ~F.coalesce(c, F.lit(False))
    reasons = F.array_compact(
        F.array(
            F.when(fine(F.col("recipe_id") == F.col("provenance.recipe_id")), "recipe_id differs"),
            F.when(fine(F.col("rendering_metadata.line_count") == lines), "line_count differs"),
            F.when(fine(told == F.array(*[seen[n] for n in COVERAGE])), "coverage differs"),
            F.when(fine(is_nfc(text)), "not in normal form C"),
            F.when(fine(~text.contains("�")), "replacement character"),
            F.when(fine(F.size("pages") > 0), "no pages"),
        )
    )
    out = out.unionByName(samples.select(F.col("sample_id").alias("part"), F.explode(reasons).alias("reason")))

    files = images(spark, root).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), F.col("sha256").alias("f_sha"), "format", F.col("width").alias("f_w"), F.col("height").alias("f_h"))
    at = F.concat(F.lit(str(Path(root).resolve()) + "/"), F.col("asset_path"))
    joined = pages.withColumn("path", at).join(files, "path", "left")
    reason = (
        F.when(~is_portable(F.col("asset_path"), **VARIANTS["batch"]), "path is not portable")
        .when(F.col("f_sha").isNull(), "file is missing")
        .when(F.col("f_sha") != F.col("sha256"), "sha256 differs")
        .when(F.coalesce(F.concat(F.lit("image/"), F.col("format")) != F.col("media_type"), F.lit(True)), "media type differs")
        .when(F.coalesce((F.col("f_w") != F.col("width")) | (F.col("f_h") != F.col("height")), F.lit(True)), "dimensions differ")
    )
    out = out.unionByName(joined.select(F.col("page_id").alias("part"), reason.alias("reason")).filter("reason IS NOT NULL"))
    missing = uncovered(samples.withColumn("flags", F.map_filter("hebrew_coverage", lambda k, v: k.isin(*REQUIRED))), "flags")
    return out.unionByName(missing.select(F.col("name").alias("part"), F.lit("no sample has it").alias("reason")))

"""Source adapters: candidates of a source, their metadata, and copies of their assets.

An adapter is a pair of frames-in, frames-out functions registered under the
name that configurations use. What a step cannot do for a row is a row of its
violations, so one bad record stops nothing before the caller says so.

``discover`` gives (candidate_id, source_id, source_item_id, source_url,
discovery_method, title, pos, location, depth_only); ``enrich`` adds (raw_rights,
assets <path, media_type>, metadata); ``acquire`` copies assets and gives one row
a file.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.paths import resolve
from ledgerloom.sinks.release import copy_files
from ledgerloom.sources import manifests, readers


@dataclass(frozen=True)
class Options:
    """What a run asks of its sources: which ones, how many candidates of each, which synthetic samples, depth-only records or not."""

    sources: frozenset[str] | None = None
    most: int | None = None
    templates: frozenset[str] | None = None
    recipes: frozenset[str] | None = None
    degradations: frozenset[str] | None = None
    depth: bool = False


@dataclass(frozen=True)
class Adapter:
    discover: Callable[[SparkSession, dict, Options], DataFrame]
    enrich: Callable[[SparkSession, dict, DataFrame, Options], tuple[DataFrame, DataFrame]]
    #: how many assets of an item are copied; null for all
    assets: int | None = None


ADAPTERS: dict[str, Adapter] = {}


def _candidates(df: DataFrame, source: dict, options: Options, method: str) -> DataFrame:
    """The first ``most`` rows (id, url, title, pos, location, depth_only) of a source, without depth-only ones unless wanted."""
    depth = F.coalesce("depth_only", F.lit(False))
    kept = df if options.depth else df.filter(~depth)
    if options.most is not None:
        kept = kept.withColumn("__n", F.row_number().over(Window.partitionBy(F.lit(source["id"])).orderBy("pos"))).filter(F.col("__n") <= options.most).drop("__n")
    return kept.select(
        F.concat_ws(":", F.lit(source["id"]), "id").alias("candidate_id"),
        F.lit(source["id"]).alias("source_id"),
        F.col("id").alias("source_item_id"),
        F.col("url").alias("source_url"),
        F.when(depth, f"depth_{method}").otherwise(method).alias("discovery_method"),
        "title",
        "pos",
        "location",
        depth.alias("depth_only"),
    )


def _plain(path: str) -> Column:
    return F.regexp_replace(path, "^file:/+", "/")


_SEED = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "url", "title", "fixture_html", "notes")] + [T.StructField("f1_source_depth_only", T.BooleanType())])


def _discover_seeds(spark: SparkSession, source: dict, options: Options) -> DataFrame:
    """Seeds of a small YAML list; pages are named from the list's folder."""
    folder = str(Path(source["path"]).resolve().parent)
    package = source.get("package", folder)
    at = F.when(F.col("fixture_html").startswith("package://"), F.concat(F.lit(package + "/"), F.expr("substring(fixture_html, 11)"))).when(F.col("fixture_html").startswith("/"), F.col("fixture_html"))
    rows = readers.yaml_rows(spark, source["path"], "items", _SEED).select("id", "url", "title", F.col("ord").alias("pos"), F.coalesce(at, F.concat(F.lit(folder + "/"), "fixture_html")).alias("location"), F.col("f1_source_depth_only").alias("depth_only"))
    return _candidates(rows, source, options, "seed_manifest")


def _enrich_pages(spark: SparkSession, source: dict, candidates: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """Pages beside their seeds; a seed's title stands where the page has none. A seed without a page is a violation."""
    folder = source.get("pages", str(Path(source["path"]).resolve().parent))
    pages = readers.html_pages(spark, folder).select(_plain("path").alias("location"), F.col("title").alias("page_title"), "description", F.col("rights").alias("raw_rights"), "asset_urls")
    joined = candidates.join(pages, "location", "left")
    missing = joined.filter("asset_urls IS NULL").select("candidate_id", F.lit("no page").alias("reason"))
    base = F.regexp_replace("location", "[^/]*$", "")
    assets = F.transform("asset_urls", lambda u: F.struct(F.when(u.startswith("/"), u).otherwise(F.concat(base, u)).alias("path"), F.lit(None).cast("string").alias("media_type")))
    metadata = F.map_filter(F.create_map(F.lit("description"), F.col("description")), lambda k, v: v.isNotNull())
    found = joined.filter("asset_urls IS NOT NULL").withColumns({"title": F.coalesce("page_title", "title"), "assets": assets, "metadata": metadata})
    return found.select(*candidates.columns, "raw_rights", "assets", "metadata"), missing


def _discover_records(spark: SparkSession, source: dict, options: Options) -> DataFrame:
    records = readers.records_file(spark, source["path"])
    return _candidates(records.select("id", F.col("source_url").alias("url"), "title", "pos", F.col("asset_path").alias("location"), F.col("f1_source_depth_only").alias("depth_only")), source, options, "static_importer")


def _enrich_records(spark: SparkSession, source: dict, candidates: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """Records beside themselves: collection, period and upstream identifier as metadata, one asset. A record without an asset is a violation."""
    folder = str(Path(source["path"]).resolve().parent)
    records = readers.records_file(spark, source["path"]).select(F.col("id").alias("source_item_id"), "collection", "period", "upstream_identifier", "raw_rights").dropDuplicates(["source_item_id"])
    joined = candidates.join(records, "source_item_id")
    package = source.get("package", folder)
    path = F.when(F.col("location").startswith("package://"), F.concat(F.lit(package + "/"), F.expr("substring(location, 11)"))).when(F.col("location").startswith("/"), F.col("location")).otherwise(F.concat(F.lit(folder + "/"), "location"))
    fields = ("collection", "period", "upstream_identifier")
    metadata = F.map_filter(F.create_map(*[x for n in fields for x in (F.lit(n), F.col(n))]), lambda k, v: v.isNotNull())
    found = joined.withColumns({"assets": F.array(F.struct(path.alias("path"), F.lit(None).cast("string").alias("media_type"))), "metadata": metadata})
    missing = joined.filter("location IS NULL").select("candidate_id", F.lit("no asset").alias("reason"))
    return found.filter("location IS NOT NULL").select(*candidates.columns, "raw_rights", "assets", "metadata"), missing


def _samples(spark: SparkSession, source: dict, options: Options) -> DataFrame:
    """The samples that the run's synthetic filters let pass."""
    samples = manifests.batch_samples(spark, f"{source['path']}/{source.get('manifest', 'manifest.json')}")
    for column, wanted in (("template_id", options.templates), ("recipe_id", options.recipes), ("degradation_preset", options.degradations)):
        if wanted:
            samples = samples.filter(F.col(f"provenance.{column}").isin(sorted(wanted)))
    return samples


def _discover_batch(spark: SparkSession, source: dict, options: Options) -> DataFrame:
    samples = _samples(spark, source, options)
    if samples.isEmpty():
        raise ValueError(f"the filters leave no sample of {source['id']}")
    titled = samples.join(manifests.batch_metadata(samples).select("sample_id", "title"), "sample_id")
    index = F.col("provenance.sample_index")
    rows = titled.select(F.concat(F.lit("synthetic-"), index.cast("string")).alias("id"), F.concat(F.lit("synthetic://"), "sample_id").alias("url"), "title", index.alias("pos"), F.col("sample_id").alias("location"), F.lit(False).alias("depth_only"))
    return _candidates(rows, source, options, "generation_manifest")


def _enrich_batch(spark: SparkSession, source: dict, candidates: DataFrame, options: Options) -> tuple[DataFrame, DataFrame]:
    """Samples beside their candidates, with all pages. A candidate that the filters no longer let pass is a violation."""
    samples = _samples(spark, source, options)
    root = str(Path(source["path"]).resolve())
    pages = F.transform("pages", lambda p: F.struct(F.concat(F.lit(root + "/"), p["asset_path"]).alias("path"), p["media_type"].alias("media_type")))
    side = samples.select("sample_id", F.col("license").alias("raw_rights"), pages.alias("assets")).join(manifests.batch_metadata(samples).select("sample_id", "metadata"), "sample_id").withColumnRenamed("sample_id", "location")
    missing = candidates.join(side.select("location"), "location", "left_anti").select("candidate_id", F.lit("sample not allowed").alias("reason"))
    return candidates.join(side, "location").select(*candidates.columns, "raw_rights", "assets", "metadata"), missing


ADAPTERS |= {
    "seed_pages": Adapter(_discover_seeds, _enrich_pages),
    "records": Adapter(_discover_records, _enrich_records, assets=1),
    "batch": Adapter(_discover_batch, _enrich_batch),
}


def _adapter(source: dict) -> Adapter:
    if source["adapter"] not in ADAPTERS:
        raise KeyError(f"no adapter named {source['adapter']!r}")
    return ADAPTERS[source["adapter"]]


def collect_sources(spark: SparkSession, sources: list[dict], options: Options = Options()) -> tuple[DataFrame, DataFrame]:
    """(enriched candidates, violations) of all the sources that the run wants, in one frame each."""
    wanted = [s for s in sources if options.sources is None or s["id"] in options.sources]
    if not wanted:
        raise ValueError("no source is selected")
    found = missing = None
    for s in wanted:
        adapter = _adapter(s)
        rows, bad = adapter.enrich(spark, s, adapter.discover(spark, s, options), options)
        rows = rows.withColumn("assets", rows["assets"] if adapter.assets is None else F.slice("assets", 1, adapter.assets)).withColumn("pos", F.col("pos").cast("long"))
        found = rows if found is None else found.unionByName(rows)
        missing = bad if missing is None else missing.unionByName(bad)
    return found, missing


def acquire(enriched: DataFrame, target: str) -> DataFrame:
    """(path, size, sha256, problem) of the assets copied to ``<candidate>/page_<at>`` below ``target``, in their order."""
    spread = enriched.select("candidate_id", F.posexplode("assets").alias("at", "a"))
    ending = F.coalesce(F.nullif(F.lower(F.regexp_extract("a.path", r"(\.[A-Za-z0-9]+)$", 1)), F.lit("")), F.lit(".svg"))
    name = F.concat(F.regexp_replace("candidate_id", "[^A-Za-z0-9._-]", "_"), F.format_string("/page_%d", F.col("at") + 1), ending)
    return copy_files(spread.select(F.col("a.path").alias("source"), name.alias("target")), "/", target)


def config_path(source: dict, name: str, root: str | None = None, package: str | None = None) -> str:
    """A path of a source's settings, resolved as configurations name them."""
    return str(resolve(source[name], root, package))

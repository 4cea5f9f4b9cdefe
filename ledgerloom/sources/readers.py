"""Readers for the file layouts that datasets of scanned documents come in.

Each returns a DataFrame with a declared schema. Shape errors are found by
checks that return violations, not by reading and failing half way.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.media import describe_image
from ledgerloom.storage import materialize

RECORD = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "title", "source_url", "upstream_identifier", "collection", "period", "raw_rights", "asset_path")]
    + [T.StructField("f1_source_depth_only", T.BooleanType())]
)


def records_file(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Rows of documents of the form ``{"records": [...]}``, with the position in their file."""
    wrapped = T.StructType([T.StructField("records", T.ArrayType(schema))])
    docs = spark.read.schema(wrapped).json(path, multiLine=True, mode="FAILFAST")
    return docs.select(F.posexplode("records").alias("pos", "r")).select("pos", "r.*")


def unknown_fields(spark: SparkSession, path: str, field: str, schema: T.StructType) -> DataFrame:
    """(field, n): keys of the listed objects that the schema does not name; the JSON reader drops them silently."""
    raw = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"struct<{field}: array<string>>").getField(field)
    keys = raw.select(F.explode(listed).alias("o")).select(F.explode(F.json_object_keys("o")).alias("field"))
    return keys.filter(~F.col("field").isin(schema.fieldNames())).groupBy("field").agg(F.count("*").alias("n"))


def text_records(spark: SparkSession, path: str, value_field: str = "text") -> DataFrame:
    """(item_id, text) from JSON lines, a JSON list or ``{"items": [...]}``."""
    row = T.StructType([T.StructField("item_id", T.StringType()), T.StructField(value_field, T.StringType())])
    if path.endswith((".jsonl", ".ndjson")):
        return spark.read.schema(row).json(path, mode="FAILFAST").select("item_id", F.col(value_field).alias("text"))
    raw = spark.read.text(path, wholetext=True)
    # the JSON parser takes one object for a list of one, so the outer mark decides
    items = F.from_json("value", T.StructType([T.StructField("items", T.ArrayType(row))])).getField("items")
    is_list = F.substring(F.ltrim("value"), 1, 1) == "["
    listed = F.when(is_list, F.from_json("value", T.ArrayType(row))).otherwise(items)
    return raw.select(F.explode(listed).alias("i")).select("i.item_id", F.col(f"i.{value_field}").alias("text"))


class _Page(HTMLParser):
    """What a catalogue page says of its item, wherever an attribute stands; entities are undone by the parser."""

    #: class of the marked element: (field, elements that may carry it)
    MARKED = {"item-title": ("title", {"h1", "span", "div"}), "rights-label": ("rights", {"span", "div"}), "item-description": ("description", {"p", "div"})}
    META = {("property", "og:title"): "title", ("name", "description"): "description"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: dict[str, str] = {}
        self.assets: list[str] = []
        self.open: list[tuple[str, str | None]] = []

    def _take(self, field: str, value: str | None) -> None:
        if value and value.strip():
            self.found.setdefault(field, value.strip())

    def handle_starttag(self, tag, attrs):
        has = dict(attrs)
        if tag == "meta":
            for (attribute, name), field in self.META.items():
                if has.get(attribute) == name:
                    self._take(field, has.get("content"))
        elif tag == "img":
            if has.get("class") == "page-image" and has.get("src"):
                self.assets.append(has["src"])
        else:
            field, elements = self.MARKED.get(has.get("class") or "", (None, ()))
            self.open.append((tag, field if tag in elements else None))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in ("meta", "img"):
            self.open.pop()

    def handle_endtag(self, tag):
        # an element that is never closed ends with the one around it
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        for _, field in self.open:
            if field:
                self._take(field, data)


def parse_page(html: str) -> tuple[str | None, str | None, str | None, list[str]]:
    """(title, description, rights, asset addresses) of one page; meta elements come before marked ones, the first of each counts."""
    page = _Page()
    page.feed(html)
    page.close()
    return page.found.get("title"), page.found.get("description"), page.found.get("rights"), page.assets


def _parse_pages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        found = pd.DataFrame([parse_page(h) for h in pdf["html"]], columns=["title", "description", "rights", "asset_urls"])
        yield pd.concat([pdf[["path"]].reset_index(drop=True), found], axis=1)


def html_pages(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, description, rights, asset_urls) of catalogue pages; what a page lacks is null; an empty file is no page."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return raw.mapInPandas(_parse_pages, "path string, title string, description string, rights string, asset_urls array<string>")


def iiif_asset_urls(manifests: DataFrame, column: str, most: int = 5) -> DataFrame:
    """``manifests`` with ``asset_urls``: the images of a IIIF manifest's canvases in order, the first ``most``."""
    image = "array<struct<resource: struct<`@id`: string>>>"
    shape = f"struct<sequences: array<struct<canvases: array<struct<images: {image}>>>>>"
    parsed = F.from_json(column, shape)
    canvases = F.flatten(F.transform(parsed["sequences"], lambda s: F.coalesce(s["canvases"], F.array())))
    images = F.flatten(F.transform(canvases, lambda c: F.coalesce(c["images"], F.array())))
    urls = F.array_compact(F.transform(images, lambda i: i["resource"]["@id"]))
    return manifests.withColumn("asset_urls", F.slice(urls, 1, most))


def iiif_metadata(column: str, label: str) -> Column:
    """The value under a label of a IIIF manifest's metadata, the first of several; null if it is no text."""
    raw = F.from_json(column, "struct<metadata: array<struct<label: string, value: string>>>")["metadata"]
    value = F.get(F.filter(raw, lambda m: m["label"] == label), F.lit(0))["value"]
    # a list comes as its JSON text
    listed = F.get(F.from_json(value, "array<string>"), F.lit(0))
    return F.when(F.startswith(F.ltrim(value), F.lit("[")), listed).when(~F.startswith(F.ltrim(value), F.lit("{")), value)


def checksum_list(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) from lines of 64 hex digits, two blanks and a path."""
    lines = spark.read.text(path)
    line = r"^([0-9a-f]{64})  (.+)$"
    return lines.filter(F.col("value").rlike(line)).select(F.regexp_extract("value", line, 2).alias("path"), F.regexp_extract("value", line, 1).alias("sha256"))


def stored_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, sha256) of all files below ``root``; contents are hashed where they are read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = Path(root).resolve().as_uri().rstrip("/") + "/"
    return files.select(F.regexp_replace(F.regexp_replace("path", "^file:/+", "file:///"), "^" + base, "").alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def images(spark: SparkSession, root: str) -> DataFrame:
    """(path, size, sha256, format, width, height, problem) of the images below ``root``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), describe_image("content").alias("i")).select("path", "size", "sha256", "i.*")


def yaml_rows(spark: SparkSession, path: str, field: str, schema: T.StructType) -> DataFrame:
    """Rows of the list under ``field`` of a small configuration file, with their order."""
    import yaml

    loaded = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    rows = [(i, *[r.get(n) for n in schema.fieldNames()]) for i, r in enumerate((loaded or {}).get(field) or [], 1)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("ord", T.IntegerType())] + schema.fields))


def in_order(df: DataFrame, by: str, blocks: int = 64) -> DataFrame:
    """``df`` with ``pos``, the place from 0 of each row by ``by``.

    Rows are parted by ranges of ``by`` and stored, so that ranges stay what
    they are; ranks run inside a range and the ranges' counts are added up.
    """
    parted = materialize(df.repartitionByRange(blocks, by).withColumn("__b", F.spark_partition_id()), "in-order")
    counts = parted.groupBy("__b").agg(F.count("*").alias("n"))
    offsets = counts.select("__b", (F.sum("n").over(Window.orderBy("__b")) - F.col("n")).alias("__offset"))  # one row a range
    inside = F.row_number().over(Window.partitionBy("__b").orderBy(by)) - 1
    return parted.withColumn("__at", inside).join(F.broadcast(offsets), "__b").withColumn("pos", (F.col("__at") + F.col("__offset")).cast("int")).drop("__b", "__at", "__offset")


Adapter = Callable[[SparkSession, dict], DataFrame]
_ADAPTERS: dict[str, Adapter] = {}


def adapter(name: str) -> Callable[[Adapter], Adapter]:
    """Registers a reader of candidates under a name that configurations use."""

    def add(f: Adapter) -> Adapter:
        _ADAPTERS[name] = f
        return f

    return add


def candidates(spark: SparkSession, sources: list[dict], most: int | None = None) -> DataFrame:
    """All sources' candidates in one frame; at most ``most`` of each source, in the source's order."""
    out = None
    for i, s in enumerate(sources):
        if s["fetcher"] not in _ADAPTERS:
            raise KeyError(f"no adapter named {s['fetcher']!r}")
        part = _ADAPTERS[s["fetcher"]](spark, s).withColumns({"source_id": F.lit(s["id"]), "source_rank": F.lit(i)})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if most is not None:
        w = Window.partitionBy("source_id").orderBy("pos")
        out = out.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= most).drop("__n")
    return out


@adapter("records_json")
def _records(spark: SparkSession, source: dict) -> DataFrame:
    return records_file(spark, source["path"])


@adapter("html_pages")
def _html(spark: SparkSession, source: dict) -> DataFrame:
    return in_order(html_pages(spark, source["path"]), "path")


def canonical_json(value) -> str:
    """Text form of a small report: sorted keys, two blanks of indent, ASCII, a line end."""
    return json.dumps(value, sort_keys=True, indent=2, ensure_ascii=True) + "\n"

"""Release trees: partitioned data, manifests, checksums and archives.

Rows are written by Spark. Only small reports and the copying of finished files
happen on the driver.
"""

from __future__ import annotations

import hashlib
import io
import json
import os
import tarfile
import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.paths import is_portable
from ledgerloom.operators.validation import checksum_status
from ledgerloom.sources.readers import canonical_json, stored_files
from ledgerloom.storage import materialize


def write_data(df: DataFrame, path: str, split: str, rows_per_file: int = 5_000_000) -> None:
    """One folder a split; rows go to it where they lie, without a shuffle."""
    df.write.option("maxRecordsPerFile", rows_per_file).partitionBy(split).mode("errorifexists").parquet(path)


def write_manifests(frames: dict[str, DataFrame], folder: str) -> None:
    for name, df in frames.items():
        df.write.mode("errorifexists").json(f"{folder}/{name}")


def publish(path: str, payload: dict) -> None:
    """A small report, written beside its place and moved into it, so that readers see all of it or none."""
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    draft = target.with_name(f".{target.name}.draft")
    draft.write_text(canonical_json(payload), encoding="ascii")
    os.replace(draft, target)


def publish_all(payloads: dict[str, dict]) -> None:
    """Several small reports: all are written beside their places before any is moved into it."""
    drafts = []
    try:
        for path, payload in payloads.items():
            target = Path(path)
            target.parent.mkdir(parents=True, exist_ok=True)
            draft = target.with_name(f".{target.name}.{uuid.uuid4().hex}")
            drafts.append((draft, target))
            draft.write_text(canonical_json(payload), encoding="ascii")
        for draft, target in drafts:
            os.replace(draft, target)
    finally:
        for draft, _ in drafts:
            draft.unlink(missing_ok=True)


def write_release(spark: SparkSession, root: str, data: DataFrame, split: str, manifests: dict[str, DataFrame], reports: dict[str, dict]) -> DataFrame:
    """A whole release tree: data by split, manifests, reports, and the checksums of all of it, which are returned."""
    write_data(data, f"{root}/data", split)
    write_manifests(manifests, f"{root}/manifests")
    publish_all({f"{root}/docs/{name}.json": payload for name, payload in reports.items()})
    sums = materialize(checksum_manifest(spark, root), "checksums")
    sums.coalesce(1).write.mode("errorifexists").json(f"{root}/checksums")
    return sums


def checksum_manifest(spark: SparkSession, root: str) -> DataFrame:
    """(path, category, size, sha256) of every file of a release tree; hashed on the executors."""
    path = F.col("path")
    category = F.when(path.startswith("data/"), "data").when(path.startswith("manifests/"), "manifest").when(path.startswith("docs/"), "document").when(path.rlike(r"\.tar(\.gz)?$"), "archive").otherwise("other")
    files = stored_files(spark, root).filter(~path.rlike(r"(^|/)\."))
    return files.select("path", category.alias("category"), "size", "sha256")


def verify(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """(path, status) of the files that are not as the manifest says."""
    status = checksum_status(manifest, checksum_manifest(spark, root), "path", "sha256")
    return status.filter("status <> 'ok'")


def archive(root: str, target: str, leave_out: Iterable[str] = (), below: str = "") -> str:
    """A tar of the tree, or of what lies ``below``, with fixed order, owners and times; its digest depends on the contents alone."""
    base, skip, digest = Path(root), set(leave_out), hashlib.sha256()
    draft = Path(target).with_name(f".{Path(target).name}.{uuid.uuid4().hex}")
    files = sorted(p for p in (base / below).rglob("*") if p.is_file() and p.resolve() not in (Path(target).resolve(), draft.resolve()))
    with draft.open("wb") as raw:

        class Both(io.RawIOBase):
            """Hashes what it writes."""

            def write(self, data):
                digest.update(data)
                return raw.write(data)

        with tarfile.open(fileobj=Both(), mode="w|") as tar:
            for file in files:
                name = file.relative_to(base).as_posix()
                if name in skip:
                    continue
                info = tarfile.TarInfo(name)
                info.size = file.stat().st_size
                info.mode = 0o644
                with file.open("rb") as f:
                    tar.addfile(info, f)
    os.replace(draft, target)
    return digest.hexdigest()


def _archive_part(root: str, target: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        Path(target).mkdir(parents=True, exist_ok=True)
        for pdf in batches:
            names = [f"{part.replace('/', '_')}.tar" for part in pdf["part"]]
            yield pd.DataFrame({"path": names, "sha256": [archive(root, f"{target}/{n}", below=p) for n, p in zip(names, pdf["part"])]})

    return run


def archives(spark: SparkSession, root: str, parts: Iterable[str], target: str) -> DataFrame:
    """(path, sha256) of one tar for each named part of a tree in a shared folder; a task writes one part."""
    rows = spark.createDataFrame([(p,) for p in parts], "part string")
    return materialize(rows.repartition(max(1, rows.count()), "part").mapInPandas(_archive_part(root, target), "path string, sha256 string"), "archives")


def yaml_text(value) -> str:
    """Text form of a small configuration: keys in their order, letters of all scripts as they are."""
    import yaml

    return yaml.safe_dump(value, sort_keys=False, allow_unicode=True)


def _write_each(folder: str, name: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        base = Path(folder)
        base.mkdir(parents=True, exist_ok=True)
        for pdf in batches:
            paths = []
            for file, text in zip(pdf[name], pdf["__json"]):
                draft = base / f".{file}.{uuid.uuid4().hex}"
                draft.write_text(canonical_json(json.loads(text)), encoding="ascii")
                os.replace(draft, base / f"{file}.json")
                paths.append(f"{file}.json")
            yield pd.DataFrame({"file": paths})

    return run


def write_each(df: DataFrame, name: str, folder: str) -> int:
    """One canonical JSON file a row in a shared folder, named by column ``name``; written on the executors, again without harm. The number of files."""
    safe = F.regexp_replace(F.col(name).cast("string"), "[^A-Za-z0-9._-]", "_")
    rows = df.select(safe.alias(name), F.to_json(F.struct(*df.columns)).alias("__json"))
    return rows.mapInPandas(_write_each(folder, name), "file string").distinct().count()


def _copy(root: str, target: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for source, to in zip(pdf["source"], pdf["target"]):
                source_file, file = Path(root) / source, Path(target) / to
                if not source_file.is_file():
                    out.append((to, None, None, "missing"))
                    continue
                file.parent.mkdir(parents=True, exist_ok=True)
                draft, digest, size = file.with_name(f".{file.name}.{uuid.uuid4().hex}"), hashlib.sha256(), 0
                with source_file.open("rb") as a, draft.open("wb") as b:
                    while chunk := a.read(1 << 20):
                        digest.update(chunk)
                        size += b.write(chunk)
                os.replace(draft, file)
                out.append((to, size, digest.hexdigest(), None))
            yield pd.DataFrame(out, columns=["path", "size", "sha256", "problem"]).astype({"size": "Int64"})

    return run


def copy_assets(assets: DataFrame, root: str, target: str, files_a_task: int = 2_000) -> DataFrame:
    """(path, size, sha256, problem) of the assets (source, split, item_id, at) copied to ``data/<split>/<item>/page_<at>``.

    Copied on the executors between shared folders, hashed on the way, each file
    moved into its place when it is whole. Paths that aren't portable are not
    followed.
    """
    ending = F.regexp_extract("source", r"(\.[A-Za-z0-9]+)$", 1)
    name = F.concat_ws("/", F.lit("data"), F.coalesce("split", F.lit("none")), F.regexp_replace("item_id", "[^A-Za-z0-9._-]", "_"), F.concat(F.format_string("page_%d", F.col("at")), ending))
    rows = assets.select("source", name.alias("target")).withColumn("ok", is_portable(F.col("source")))
    copied = copy_files(rows.filter("ok"), root, target, files_a_task)
    refused = rows.filter("NOT ok").select(F.col("target").alias("path"), F.lit(None).cast("long").alias("size"), F.lit(None).cast("string").alias("sha256"), F.lit("not portable").alias("problem"))
    return copied.unionByName(refused)


def copy_files(files: DataFrame, root: str, target: str, files_a_task: int = 2_000) -> DataFrame:
    """(path, size, sha256, problem) of files (source, target) copied from below ``root`` to below ``target``, both shared folders."""
    parts = max(1, -(-files.count() // files_a_task))
    return materialize(files.select("source", "target").repartition(parts).mapInPandas(_copy(root, target), "path string, size long, sha256 string, problem string"), "copied")

import hashlib
import tarfile

import pytest

from ledgerloom.plans.stages import Stage, execute
from ledgerloom.sinks import release


def test_release_tree(spark, tmp_path):
    root = tmp_path / "r"
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "id string, split string")
    release.write_data(df, str(root / "data"), "split")
    release.write_manifests({"items": df}, str(root / "manifests"))
    release.publish(str(root / "docs/report.json"), {"b": 1, "a": "é"})
    assert (root / "docs/report.json").read_text() == '{\n  "a": "\\u00e9",\n  "b": 1\n}\n'
    files = release.checksum_manifest(spark, str(root))
    manifest = spark.createDataFrame(files.collect(), files.schema)
    assert {r.category for r in manifest.collect()} >= {"data", "manifest", "document"}
    assert release.verify(spark, str(root), manifest).count() == 0
    first = release.archive(str(root), str(tmp_path / "x.tar"), leave_out=["docs/report.json"])
    (root / "docs/report.json").write_text("changed")
    assert [tuple(r) for r in release.verify(spark, str(root), manifest).collect()] == [("docs/report.json", "mismatch")]
    assert release.archive(str(root), str(tmp_path / "y.tar"), leave_out=["docs/report.json"]) == first


def test_resume(spark, tmp_path):
    ran = []

    def step(name, fail=False):
        def run(s, frames):
            ran.append(name)
            if fail:
                raise RuntimeError(name)
            return {"items": frames["items"].selectExpr("id + 1 AS id"), name: frames["items"]}

        return Stage(name, run)

    inputs = {"items": spark.range(3)}
    with pytest.raises(RuntimeError):
        execute(spark, [step("one"), step("two"), step("three", fail=True)], str(tmp_path), inputs)
    ran.clear()
    frames = execute(spark, [step("one"), step("two"), step("three")], str(tmp_path), inputs)
    assert ran == ["three"]
    assert sorted(r.id for r in frames["items"].collect()) == [3, 4, 5] and {"one", "two", "three"} <= set(frames)
    assert set(execute(spark, [step("one"), step("two")], str(tmp_path), inputs, until="one")) == {"items", "one"}
    with pytest.raises(ValueError):
        execute(spark, [step("one")], str(tmp_path), inputs, until="no")


def test_archives_by_part(spark, tmp_path):
    for name in ("data/train/a", "data/train/b", "data/test/c", "docs/d"):
        (tmp_path / "tree" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "tree" / name).write_text(name)
    got = {r.path: r.sha256 for r in release.archives(spark, str(tmp_path / "tree"), ["data/train", "data/test"], str(tmp_path / "out")).collect()}
    assert set(got) == {"data_train.tar", "data_test.tar"}
    assert all(hashlib.sha256((tmp_path / "out" / p).read_bytes()).hexdigest() == d for p, d in got.items())
    with tarfile.open(tmp_path / "out/data_train.tar") as tar:
        assert tar.getnames() == ["data/train/a", "data/train/b"]


def test_a_whole_release(spark, tmp_path):
    root = str(tmp_path / "rel")
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "id string, split string")
    sums = release.write_release(spark, root, df, "split", {"items": df}, {"card": {"n": 2}, "notes": {}})
    assert {r.category for r in sums.collect()} == {"data", "manifest", "document"}
    assert release.verify(spark, root, sums).filter("path NOT LIKE 'checksums/%'").count() == 0
    with pytest.raises(TypeError):
        release.publish_all({f"{root}/docs/new.json": {}, f"{root}/docs/bad.json": {"x": object()}})
    assert sorted(p.name for p in (tmp_path / "rel/docs").iterdir() if not p.name.endswith(".crc")) == ["card.json", "notes.json"]

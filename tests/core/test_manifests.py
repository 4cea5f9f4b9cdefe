import hashlib
import json
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import perceptual
from ledgerloom.operators import evaluation
from ledgerloom.sinks import release
from ledgerloom.sources import manifests as m


def png(pixels, kind=0, filters=(0,), palette=None):
    """A PNG of an array (height, width, channels), its lines written with the filters in turn."""
    h, w, c = pixels.shape
    up, lines = np.zeros((w, c), dtype=np.int32), []
    for y in range(h):
        f, line = filters[y % len(filters)], pixels[y].astype(np.int32)
        left = np.vstack([np.zeros((1, c), dtype=np.int32), line[:-1]])
        corner = np.vstack([np.zeros((1, c), dtype=np.int32), up[:-1]])
        p = left + up - corner
        da, db, dc = abs(p - left), abs(p - up), abs(p - corner)
        paeth = np.where((da <= db) & (da <= dc), left, np.where(db <= dc, up, corner))
        out = line - [0, left, up, (left + up) // 2, paeth][f]
        lines.append(bytes([f]) + (out & 255).astype(np.uint8).tobytes())
        up = line

    def chunk(name, data):
        return struct.pack(">I", len(data)) + name + data + struct.pack(">I", zlib.crc32(name + data))

    head = chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, kind, 0, 0, 0))
    plte = chunk(b"PLTE", palette.tobytes()) if palette is not None else b""
    return b"\x89PNG\r\n\x1a\n" + head + plte + chunk(b"IDAT", zlib.compress(b"".join(lines))) + chunk(b"IEND", b"")


def test_looks(spark, tmp_path):
    rng = np.random.default_rng(2)
    smooth = (np.add.outer(np.arange(48) * 3, np.arange(40) * 2) % 200).astype(np.uint8)[:, :, None]
    for c, kind in ((1, 0), (3, 2), (4, 6), (2, 4)):
        pixels = np.concatenate([smooth, rng.integers(0, 255, (48, 40, 3), dtype=np.uint8)], axis=2)[:, :, :c]
        plain = perceptual.decode(png(pixels, kind))
        for filters in ((1,), (2,), (3,), (4,), (0, 1, 2, 3, 4)):
            assert np.array_equal(perceptual.decode(png(pixels, kind, filters)), plain), (kind, filters)
    grey = perceptual.decode(png(smooth))
    assert np.array_equal(grey, smooth[:, :, 0])
    palette = np.array([[v, v, v] for v in range(256)], dtype=np.uint8)
    assert np.array_equal(perceptual.decode(png(smooth, 3, palette=palette)), grey)
    look = perceptual.look(png(smooth))
    # written otherwise, in colour, or with a few points changed by one: looks the same; mirrored: it does not
    assert look == perceptual.look(png(smooth, 0, (4,))) == perceptual.look(png(np.repeat(smooth, 3, axis=2), 2))
    assert perceptual.look(png(smooth[:, ::-1])) != look
    flat = np.zeros((20, 20, 1), dtype=np.uint8)
    flat[:10] = 255
    touched = flat.copy()
    touched[3, 5:9] = 254
    assert perceptual.look(png(flat)) == perceptual.look(png(touched)) is not None
    assert [perceptual.look(x) for x in (None, b"", b"no image", png(flat)[:40], png(flat[:10]))] == [None] * 5
    (tmp_path / "a.png").write_bytes(png(smooth))
    (tmp_path / "b.png").write_bytes(b"broken")
    got = perceptual.looks(spark.read.format("binaryFile").load(str(tmp_path)))
    assert {r.path[-5:]: r.look for r in got.collect()} == {"a.png": look, "b.png": None}


@pytest.mark.parametrize(
    "name,body,bad",
    [
        ("a.jsonl", '{"item_id":"1","text":"x"}\n\n{"item_id":"2","text":""}\n', []),
        ("a.json", '[{"item_id":"1","text":"x","more":{"a":[1]}}]', []),
        ("b.json", ' {"items":[{"item_id":"1","text":"x"}]}', []),
        ("c.json", '{"records":[]}', ["not an object"]),
        ("d.json", '"text"', ["not an object"]),
        ("e.json", '[1, null, "x", [], {"item_id":"1","text":"x"}]', ["not an object"] * 4),
        ("f.jsonl", '{"item_id":"","text":"x"}\n{"text":"x"}\n{"item_id":5,"text":"x"}\nno json\n', ["no item_id"] * 3 + ["not an object"]),
        ("g.jsonl", '{"item_id":"1","text":null}\n{"item_id":"2","text":3}\n{"item_id":"3"}\n', ["no text"] * 3),
        ("h.jsonl", '{"item_id":"1","text":"x"}\n{"item_id":"1","text":"y"}\n', ["duplicate item_id"]),
    ],
)
def test_strict_text_records(spark, tmp_path, name, body, bad):
    (tmp_path / name).write_text(body)
    path = str(tmp_path / name)
    assert sorted(r.reason for r in m.text_record_violations(spark, path).collect()) == sorted(bad)
    if bad:
        with pytest.raises(m.ShapeError):
            m.strict_text_records(spark, path)
    else:
        assert ("1", "x") in {tuple(r) for r in m.strict_text_records(spark, path).collect()}


def test_listed_folders_and_lines(spark, tmp_path):
    schema = T.StructType([T.StructField("item_id", T.StringType()), T.StructField("n", T.IntegerType())])
    (tmp_path / "x.json").write_text('{"items": [{"item_id": "a", "n": 1}, {"item_id": "a"}]}')
    assert m.listed(spark, str(tmp_path / "x.json"), "items", schema).count() == 2
    for field, key in (("items", "item_id"), ("others", None)):
        with pytest.raises(m.ShapeError):
            m.listed(spark, str(tmp_path / "x.json"), field, schema, key)
    folder = tmp_path / "decisions"
    assert m.record_folder(spark, str(folder), schema).count() == 0
    folder.mkdir()
    assert m.record_folder(spark, str(folder), schema).count() == 0
    (folder / "1.json").write_text('{"item_id": "a",\n "n": 1}')
    (folder / "2.json").write_text('{"item_id": "b"}')
    assert sorted(tuple(r) for r in m.record_folder(spark, str(folder), schema).collect()) == [("1.json", "a", 1), ("2.json", "b", None)]
    profile = T.StructType([T.StructField("id", T.StringType())])
    with pytest.raises(m.ShapeError):
        m.yaml_folder(spark, str(folder), "id", profile)
    (folder / "a.yaml").write_text("id: p1\n")
    assert [tuple(r) for r in m.yaml_folder(spark, str(folder), "id", profile).collect()] == [("a.yaml", "p1")]
    for text in ("id: p1\n", "id: [\n"):
        (folder / "b.yaml").write_text(text)
        with pytest.raises(m.ShapeError):
            m.yaml_folder(spark, str(folder), "id", profile)
    (tmp_path / "lines.txt").write_text(" a \n\n\t\nb\n")
    assert [r.line for r in m.corpus_lines(spark, str(tmp_path / "lines.txt")).collect()] == ["a", "b"]


def sample(i, root, text="שלום לך!\nעולם 12", **change):
    data = png(np.full((3, 4, 1), i, dtype=np.uint8))
    (root / f"p{i}.png").write_bytes(data)
    page = {"page_id": f"g{i}", "asset_path": f"p{i}.png", "media_type": "image/png", "sha256": hashlib.sha256(data).hexdigest(), "width": 4, "height": 3}
    seen = {"has_hebrew_letters": True, "has_final_letters": True, "has_niqqud": False, "has_arabic_numerals": True, "has_punctuation": True, "has_mixed_ltr": False}
    s = {"sample_id": f"s{i}", "pages": [page], "text": {"logical_order": text}, "rendering_metadata": {"layout_family": "f", "line_count": 2}, "hebrew_coverage": seen, "recipe_id": "r", "provenance": {"recipe_id": "r", "sample_index": i, "seed": 7}, "license": "L"}
    return {**s, **change}


def test_batch_manifest(spark, tmp_path):
    def run(*samples):
        (tmp_path / "manifest.json").write_text(json.dumps({"manifest_version": "1.0", "provider_metadata": {"provider_version": "2"}, "samples": samples}))
        return sorted((r.part, r.reason) for r in m.batch_violations(spark, str(tmp_path)).collect())

    good = sample(1, tmp_path)
    assert run(good) == []
    kept = m.batch_metadata(m.batch_samples(spark, str(tmp_path / "manifest.json"))).first()
    assert kept.title == "שלום לך!" and kept.metadata["provider_version"] == "2" and kept.metadata["text_sha256"] == hashlib.sha256(good["text"]["logical_order"].encode()).hexdigest()
    assert "template_id" not in kept.metadata
    bare = {k: False for k in good["hebrew_coverage"]}
    bad = sample(2, tmp_path, "e\u0301\ufffd", recipe_id="other", pages=[])
    assert run(good, bad) == [("s2", r) for r in ("coverage differs", "line_count differs", "no pages", "not in normal form C", "recipe_id differs", "replacement character")]
    assert [p for p, r in run(sample(3, tmp_path, "abc\nd", hebrew_coverage={**bare, "has_mixed_ltr": True}))] == ["has_arabic_numerals", "has_final_letters", "has_hebrew_letters", "has_punctuation"]
    page = good["pages"][0]
    changes = [({"asset_path": "../x.png"}, "path is not portable"), ({"asset_path": "q.png"}, "file is missing"), ({"sha256": "0"}, "sha256 differs"), ({"media_type": "image/jpeg"}, "media type differs"), ({"width": 5}, "dimensions differ")]
    for change, reason in changes:
        assert run({**good, "pages": [{**page, **change}]}) == [("g1", reason)]
    assert run(good, {**sample(4, tmp_path), "sample_id": "s1"}) == [("s1", "duplicate sample_id")]
    assert run(good, {**good, "sample_id": "s5"}) == [("1", "duplicate sample_index"), ("g1", "duplicate page_id"), ("p1.png", "duplicate asset_path")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a/1", "é", None), ("b", "y", 2)], "id string, t string, n int")
    for _ in range(2):
        assert release.write_each(df, "id", str(tmp_path / "out")) == 2
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["a_1.json", "b.json"]
    assert (tmp_path / "out/a_1.json").read_text() == '{\n  "id": "a/1",\n  "t": "\\u00e9"\n}\n'
    (tmp_path / "in").mkdir()
    (tmp_path / "in/x.jpg").write_bytes(b"data")
    rows = [("x.jpg", "train", "i:1", 1), ("gone.jpg", "test", "i:2", 1), ("../x.jpg", None, "i:3", 1)]
    got = release.copy_assets(spark.createDataFrame(rows, "source string, split string, item_id string, at int"), str(tmp_path / "in"), str(tmp_path / "tree"))
    assert sorted(tuple(r) for r in got.collect()) == sorted([("data/train/i_1/page_1.jpg", 4, hashlib.sha256(b"data").hexdigest(), None), ("data/test/i_2/page_1.jpg", None, None, "missing"), ("data/none/i_3/page_1.jpg", None, None, "not portable")])
    assert [p.name for p in (tmp_path / "tree").rglob("*") if p.is_file()] == ["page_1.jpg"]
    pytest.importorskip("yaml")
    assert release.yaml_text({"b": "é", "a": [1]}) == "b: é\na:\n- 1\n"


def test_evaluation_report(spark):
    side = lambda rows: spark.createDataFrame(rows, "item_id string, text string")
    examples = side([("a", ""), ("b", "")]).select("item_id")
    full = [("a", "שלום"), ("b", "x")]
    r = evaluation.report(examples, side([("a", "שלם"), ("b", "x")]), side(full)).first()
    assert (r.ready, r.error_rate, r.exact_rate, r.coverage) == (True, 0.2, 0.5, 1.0)
    for p, refs in [(full + [("z", "q")], full), (full, full + [("z", "q")]), (full[:1], full), (full, full[:1]), ([], [])]:
        assert evaluation.report(examples, side(p), side(refs)).first().ready is False
    assert evaluation.report(examples.limit(0), side([]), side([])).first().ready is False
    assert [x.item_id for x in evaluation.unexpected(side(full + [("z", "q")] * 2), examples).collect()] == ["z"]

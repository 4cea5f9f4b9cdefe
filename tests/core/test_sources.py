import json
import struct
import zlib

import pytest
from pyspark.sql import types as T

from ledgerloom.functions import media
from ledgerloom.operators.validation import checksum_status
from ledgerloom.sources import readers


def png(width, height):
    body = b"IHDR" + struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + body + struct.pack(">I", zlib.crc32(body))


def jpeg(width, height):
    return b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"xx" + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x00" * 6


@pytest.mark.parametrize(
    "data,want",
    [
        (png(640, 480), ("png", 640, 480, None)),
        (jpeg(320, 200), ("jpeg", 320, 200, None)),
        (b"<svg width='12.5px' height='7.5'></svg>", ("svg", 12, 8, None)),
        (b"<?xml version='1.0'?><svg viewBox='0 0 30 40'/>", ("svg", 30, 40, None)),
        (b"", (None, None, None, "empty")),
        (b"nothing", (None, None, None, "unknown_format")),
        (b"\x89PNG\r\n\x1a\n", ("png", None, None, "no_dimensions")),
    ],
)
def test_describe(data, want):
    assert media.describe(data) == want


def test_images_and_checksums(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.png").write_bytes(png(3, 4))
    (tmp_path / "y.jpg").write_bytes(jpeg(5, 6))
    got = {r.path.split("/")[-1]: (r.format, r.width, r.height) for r in readers.images(spark, str(tmp_path)).collect()}
    assert got == {"x.png": ("png", 3, 4), "y.jpg": ("jpeg", 5, 6)}
    stored = readers.stored_files(spark, str(tmp_path))
    digests = {r.path: r.sha256 for r in stored.collect()}
    assert set(digests) == {"a/x.png", "y.jpg"}
    listing = tmp_path.parent / "SUMS"
    listing.write_text(f"{digests['y.jpg']}  y.jpg\n{'0' * 64}  a/x.png\n{'1' * 64}  gone.txt\nnot a line\n")
    status = checksum_status(readers.checksum_list(spark, str(listing)), stored, "path", "sha256")
    assert {r.path: r.status for r in status.collect()} == {"y.jpg": "ok", "a/x.png": "mismatch", "gone.txt": "missing"}


def test_records_and_unknown_fields(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text(json.dumps({"records": [{"id": "a", "title": "x"}, {"id": "b", "odd": 1}]}, indent=1))
    assert [(r.pos, r.id, r.title) for r in readers.records_file(spark, str(path)).collect()] == [(0, "a", "x"), (1, "b", None)]
    assert [(r.field, r.n) for r in readers.unknown_fields(spark, str(path), "records", readers.RECORD).collect()] == [("odd", 1)]
    both = readers.candidates(spark, [{"id": "s1", "fetcher": "records_json", "path": str(path)}, {"id": "s2", "fetcher": "records_json", "path": str(path)}], most=1)
    assert sorted((r.source_id, r.id) for r in both.collect()) == [("s1", "a"), ("s2", "a")]
    with pytest.raises(KeyError):
        readers.candidates(spark, [{"id": "s", "fetcher": "nope"}])


@pytest.mark.parametrize("name,body", [("a.jsonl", '{"item_id":"1","text":"x"}\n{"item_id":"2","text":"y"}\n'), ("a.json", '[{"item_id":"1","text":"x"},{"item_id":"2","text":"y"}]'), ("b.json", '{"items":[{"item_id":"1","text":"x"},{"item_id":"2","text":"y"}]}')])
def test_text_records(spark, tmp_path, name, body):
    (tmp_path / name).write_text(body)
    assert sorted(tuple(r) for r in readers.text_records(spark, str(tmp_path / name)).collect()) == [("1", "x"), ("2", "y")]


def test_html_and_iiif(spark, tmp_path):
    (tmp_path / "p.html").write_text(
        '<html><head><meta property="og:title" content="A title"><meta name="description" content="About"></head>'
        '<body><span class="rights-label">Free</span><img class="page-image" src="1.jpg"><img class="page-image" src="2.jpg"></body></html>'
    )
    r = readers.html_pages(spark, str(tmp_path / "p.html")).first()
    assert (r.title, r.description, r.rights, r.asset_urls) == ("A title", "About", "Free", ["1.jpg", "2.jpg"])
    manifest = {"sequences": [{"canvases": [{"images": [{"resource": {"@id": f"u{i}"}}]} for i in range(7)]}]}
    df = spark.createDataFrame([(json.dumps(manifest),), (None,), ("{}",)], "m string")
    assert [r.asset_urls for r in readers.iiif_asset_urls(df, "m").collect()] == [["u0", "u1", "u2", "u3", "u4"], None, None]


def test_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "l.yaml").write_text("licenses:\n  - id: A\n    open: true\n  - id: B\n")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("open", T.BooleanType())])
    assert [tuple(r) for r in readers.yaml_rows(spark, str(tmp_path / "l.yaml"), "licenses", schema).collect()] == [(1, "A", True), (2, "B", None)]
    assert readers.canonical_json({"b": "é", "a": 1}) == '{\n  "a": 1,\n  "b": "\\u00e9"\n}\n'


def test_pages_as_they_are_written(spark, tmp_path):
    pages = {
        "a": '<meta content="T &amp; &quot;x&quot;" lang="en" property="og:title"><div class="item-description"><b>About</b> it</div><div class=rights-label> Free </div><img src="b.jpg" alt="" class="page-image"><img class="page-image">',
        "b": '<h1 class="item-title">One</h1><h1 class="item-title">Two</h1><p class="rights-label">no label</p><p>plain',
        "c": "<p>",
        "empty": "",
    }
    for name, body in pages.items():
        (tmp_path / f"{name}.html").write_text(body)
    got = {r.path[-6]: tuple(r)[1:] for r in readers.html_pages(spark, str(tmp_path)).collect()}
    assert got == {"a": ('T & "x"', "About", "Free", ["b.jpg"]), "b": ("One", None, None, []), "c": (None, None, None, [])}
    listed = readers.candidates(spark, [{"id": "s", "fetcher": "html_pages", "path": str(tmp_path)}])
    assert [(r.pos, r.path[-6]) for r in listed.orderBy("pos").collect()] == [(0, "a"), (1, "b"), (2, "c")]


def test_iiif_metadata(spark):
    cases = [('{"metadata":[{"label":"x","value":"1"},{"label":"Rights","value":"Free"}]}', "Free"), ('{"metadata":[{"label":"Rights","value":["a","b"]}]}', "a"), ('{"metadata":[{"label":"Rights","value":{"a":1}}]}', None), ('{"metadata":[]}', None), ("{}", None), (None, None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "m string")
    assert [r.v for r in df.select(readers.iiif_metadata("m", "Rights").alias("v")).collect()] == [w for _, w in cases]

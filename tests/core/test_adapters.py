import json

import pytest

from ledgerloom.plans import stages
from ledgerloom.sources import adapters as ad
from test_manifests import sample


@pytest.fixture
def sources(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages/1.html").write_text('<meta property="og:title" content="Page"><span class="rights-label">Free</span><img class="page-image" src="a.JPG"><img class="page-image" src="b.png">')
    (tmp_path / "pages/2.html").write_text("<p class='item-description'>About</p>")
    for name in ("a.JPG", "b.png"):
        (tmp_path / "pages" / name).write_bytes(name.encode())
    (tmp_path / "seeds.yaml").write_text(
        "items:\n- {id: s1, url: u1, title: Seed, fixture_html: pages/1.html}\n- {id: s2, url: u2, title: Seed two, fixture_html: 'package://pages/2.html'}\n"
        "- {id: s3, url: u3, fixture_html: pages/1.html, f1_source_depth_only: true}\n- {id: s4, url: u4}\n"
    )
    records = [{"id": f"r{i}", "title": f"t{i}", "source_url": f"u{i}", "raw_rights": "R", "asset_path": "x.svg" if i else "package://x.svg", "period": "modern"} for i in range(3)] + [{"id": "r9"}]
    (tmp_path / "records.json").write_text(json.dumps({"records": records}))
    (tmp_path / "x.svg").write_text("<svg/>")
    batch = tmp_path / "batch"
    batch.mkdir()
    (batch / "manifest.json").write_text(json.dumps({"manifest_version": "1.0", "samples": [sample(1, batch), sample(2, batch, provenance={"recipe_id": "q", "sample_index": 2})]}))
    return [
        {"id": "seeds", "adapter": "seed_pages", "path": str(tmp_path / "seeds.yaml"), "pages": str(tmp_path / "pages")},
        {"id": "recs", "adapter": "records", "path": str(tmp_path / "records.json")},
        {"id": "made", "adapter": "batch", "path": str(batch)},
    ]


def test_sources_end_to_end(spark, sources, tmp_path):
    rows, bad = ad.collect_sources(spark, sources)
    got = {r.candidate_id: r for r in rows.collect()}
    assert set(got) == {"seeds:s1", "seeds:s2", "recs:r0", "recs:r1", "recs:r2", "made:synthetic-1", "made:synthetic-2"}
    assert sorted(tuple(r) for r in bad.collect()) == [("recs:r9", "no asset"), ("seeds:s4", "no page")]
    assert (got["seeds:s1"].title, got["seeds:s1"].raw_rights, len(got["seeds:s1"].assets)) == ("Page", "Free", 2)
    assert (got["seeds:s2"].title, got["seeds:s2"].metadata) == ("Seed two", {"description": "About"})
    assert got["recs:r0"].metadata == {"period": "modern"} and got["made:synthetic-1"].raw_rights == "L"
    copied = {r.path: r.problem for r in ad.acquire(rows, str(tmp_path / "out")).collect()}
    assert copied == dict.fromkeys(["seeds_s1/page_1.jpg", "seeds_s1/page_2.png", "recs_r0/page_1.svg", "recs_r1/page_1.svg", "recs_r2/page_1.svg", "made_synthetic-1/page_1.png", "made_synthetic-2/page_1.png"])
    assert (tmp_path / "out/seeds_s1/page_1.jpg").read_bytes() == b"a.JPG"


def test_options(spark, sources):
    ids = lambda **kw: sorted(r.candidate_id for r in ad.collect_sources(spark, sources, ad.Options(**kw))[0].collect())
    assert ids(sources=frozenset({"seeds"}), depth=True) == ["seeds:s1", "seeds:s2", "seeds:s3"]
    assert ids(sources=frozenset({"recs"}), most=2) == ["recs:r0", "recs:r1"]
    assert ids(sources=frozenset({"made"}), recipes=frozenset({"q"})) == ["made:synthetic-2"]
    with pytest.raises(ValueError):
        ids(sources=frozenset({"made"}), templates=frozenset({"none"}))
    with pytest.raises(ValueError):
        ids(sources=frozenset())
    with pytest.raises(KeyError):
        ad.collect_sources(spark, [{"id": "x", "adapter": "nope"}])
    batch = sources[2]
    found, missing = ad.ADAPTERS["batch"].enrich(spark, batch, ad.ADAPTERS["batch"].discover(spark, batch, ad.Options()), ad.Options(recipes=frozenset({"q"})))
    assert [r.candidate_id for r in found.collect()] == ["made:synthetic-2"] and [tuple(r) for r in missing.collect()] == [("made:synthetic-1", "sample not allowed")]


def test_run_summary(spark, tmp_path):
    def run(_, frames):
        return {"a": spark.range(3), "none": spark.range(0)}

    def fail(_, frames):
        spark.range(1).write.parquet(str(tmp_path / "runs/r2/01_two/x"))
        raise RuntimeError

    with pytest.raises(RuntimeError):
        stages.execute(spark, [stages.Stage("one", run), stages.Stage("two", fail)], str(tmp_path / "runs/r2"), {})
    (tmp_path / "runs/r1").mkdir()
    folder = stages.latest_run(spark, str(tmp_path / "runs"))
    assert folder.endswith("/r2")
    got = {(r.stage, r.frame): (r.rows, r.finished, r.warning) for r in stages.summary(spark, folder).collect()}
    assert got == {("00_one", "a"): (3, True, None), ("00_one", "none"): (0, True, "no rows"), ("01_two", "x"): (None, False, "not finished")}

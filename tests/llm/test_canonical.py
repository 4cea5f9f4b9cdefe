import pytest

from ledgerloom.llm.canonical import Entry, Matcher, map_values

ENTRIES = [
    Entry("AAL-1.0", "Amber Attribution Licence 1.0", ("AAL 1.0",)),
    Entry("AAL-2.5", "Amber Attribution Licence 2.5", ("AAL 2.5",)),
    Entry("AAS-2.0", "Amber Attribution Share-Alike Licence 2.0", ("AAS 2.0",)),
    Entry("BPG-1.0", "Birch Paper Grant 1.0", ("BPG 1.0", "הענקת נייר לבנה 1.0")),
    Entry("UNKNOWN", "Not known", ()),
]

CASES = {
    "AAL-1.0": None,
    " amber attribution licence 1.0 ": None,
    "not known": None,
    "aal 1": "AAL-1.0",
    "A.A.L. version 2.5": "AAL-2.5",
    "aalv1.0": "AAL-1.0",
    "aalversion2.5, all pages": "AAL-2.5",
    "Amber_Attribution_License v. ２.５": "AAL-2.5",
    "1.0 Amber Attribution lic.": "AAL-1.0",
    "Licence, Amber Attribution ver.1": "AAL-1.0",
    "Amber Attr. Shar. Lice. 2": "AAS-2.0",
    "Ambre Atribution Shaare-Alike Licennce 2": "AAS-2.0",
    "see BIRCH PAPER GRANT [stamped]": "BPG-1.0",
    "הענקת נירר לבנה 1": "BPG-1.0",
    "Birch Paper Grant, box 1958": "BPG-1.0",
    "Amber Attribution Licence": "UNKNOWN",
    "Amber Attribution Licence 9": "UNKNOWN",
    "Granite Paper Grant 1.0": "UNKNOWN",
    "Tidal Attribution Terms 1": "UNKNOWN",
    "?": "UNKNOWN",
    "copyright until 1950": "UNKNOWN",
    "": None,
    " \t": None,
}


@pytest.mark.parametrize("value,want", CASES.items())
def test_one_value(value, want):
    got = Matcher(ENTRIES, "UNKNOWN").resolve(value)
    assert (got and got[1]) == want


def test_frame(spark):
    rows = [(i, v) for i, v in enumerate(CASES)] + [(900, None), (901, "x " * 20_000 + "A.A.L. 1"), (901, "x " * 20_000 + "A.A.L. 1"), (None, "?")]
    df = spark.createDataFrame([(i, v, "clash", "clash") for i, v in rows], "k long, value string, entry_id string, v string")
    for shard in (1, 2, 100):
        got = sorted(((r.k, r.entry_id) for r in map_values(df, "value", ["k"], ENTRIES, "UNKNOWN", shard_entries=shard).collect()), key=str)
        want = [(i, CASES[v]) for i, v in enumerate(CASES) if CASES[v]] + [(901, "AAL-1.0")] * 2 + [(None, "UNKNOWN")]
        assert got == sorted(want, key=str), shard
    assert map_values(df.limit(0), "value", ["k"], ENTRIES, "UNKNOWN").count() == 0
    assert {r.entry_id for r in map_values(df, "value", ["k"], [], "UNKNOWN").collect()} == {"UNKNOWN"}

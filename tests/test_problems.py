"""The data problems of the core against plain Python, on the smallest tables and on made-up edge cases."""

import json
import os

import pytest
from pyspark.sql import functions as F

from bidloom.operators import instants, satellites, schema_drift, snapshots, units
from bidloom.session import table
from tests import brute

DATA = "/root/testdata/sf0.001"
with_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows)), "rows repeat"
    return set(rows)


# --- snapshots ---

SNAPS = "snapshot_no int, post_id long, content_hash string, is_listed int, last_seen_at string, at string, next_no int"


@with_data
def test_snapshot_changes_on_tables(spark):
    df = table(spark, DATA, "tender_snapshots")
    rows = [tuple(r) for r in df.select("snapshot_no", "post_id", "content_hash", "is_listed", "last_seen_at").collect()]
    assert found(snapshots.snapshot_changes(df)) == brute.snapshot_changes(rows)


def test_snapshot_edges(spark):
    rows = [
        (1, 1, " AB ", 1, "2026-01-01T00:00:00Z"), (2, 1, "ab", 1, "2026-01-02T00:00:00Z"),  # only written differently
        (2, 1, "ab", 1, "2026-01-02T00:00:00Z"),  # repeated row
        (2, 1, "zz", 0, "2026-01-01T23:00:00Z"),  # an older state of the same snapshot
        (1, 2, None, 1, "2026-01-01T00:00:00Z"), (2, 2, "x", 1, "2026-01-02T00:00:00Z"), (4, 2, "x", 1, "2026-01-04T00:00:00Z"),  # null is a value; gone in 3
        (3, 3, "q", None, "2026-01-03T00:00:00Z"), (4, 3, "q", 0, "2026-01-04T00:00:00Z"),
        (3, None, "q", 1, "2026-01-03T00:00:00Z"), (None, 9, "q", 1, "2026-01-03T00:00:00Z"),
        (1, 5, "n", 1, None), (2, 5, "n", 1, "no time"),
    ]
    df = spark.createDataFrame([(*r, "clash", 7) for r in rows], SNAPS)
    assert found(snapshots.snapshot_changes(df)) == {
        (2, 2, "changed"), (3, 2, "removed"), (4, 2, "added"), (3, 3, "added"), (4, 3, "changed"), (3, 1, "removed"), (3, 5, "removed"),
    }
    assert found(snapshots.snapshot_changes(df.limit(0))) == set()


# --- history ---

HIST = "id long, post_id long, field string, old_value string, new_value string, changed_at string, slice_no int, val string"


@with_data
@pytest.mark.parametrize("least", [10_000, 1])
def test_versions_on_tables(spark, least):
    df = table(spark, DATA, "tender_history")
    rows = [tuple(r) for r in df.select("id", "post_id", "field", "old_value", "new_value", "changed_at").collect()]
    assert found(satellites.validity_view(satellites.satellite_rows(df, least=least))) == brute.versions(rows)


def test_sliced_attribute_equals_plain(spark):
    """One attribute holds nearly all rows and is cut into slices, also where all its instants are equal."""
    rows = [(1, 1, "_record", None, "t", "2026-01-01T00:00:00Z")]
    rows += [(i, 1, "a", "0", str(i // 3 % 5), f"2026-01-{1 + i % 28:02d}T00:00:{i % 60:02d}+03:00") for i in range(10, 400)]
    rows += [(i, 2, "a", None, str(i % 2), "2026-02-01T00:00:00Z") for i in range(400, 700)]
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], HIST)
    assert found(satellites.validity_view(satellites.satellite_rows(df, least=50)).distinct()) == brute.versions(rows)


def test_version_edges(spark):
    rows = [
        (1, 1, "_record", None, "t", "2026-01-01T00:00:00Z"), (1, 1, "_record", None, "t", "2026-01-01T00:00:00Z"),
        (5, 1, "qty", " 12.0 ", "12", "2026-01-03T03:00:00+03:00"),  # writes that change nothing
        (6, 1, "qty", "99", "13.50", "2026-01-03T00:00:00Z"), (4, 1, "qty", "x", None, "2026-01-02T00:00:00Z"),
        (7, 2, "a", None, "b", "2026-01-02T00:00:00Z"),  # no _record
        (None, 4, "a", "u", "v", "2026-01-02T00:00:00Z"),
        (8, None, "a", None, "b", "2026-01-02T00:00:00Z"), (9, 3, None, None, "b", "2026-01-02T00:00:00Z"), (10, 3, "a", "c", "b", "never"),
    ]
    df = spark.createDataFrame([(*r, 5, "clash") for r in rows], HIST)
    usable = [r for r in rows if r[1] is not None and r[2] is not None and r[5] != "never"]
    got = found(satellites.validity_view(satellites.satellite_rows(df)))
    assert got == brute.versions(usable)
    assert (1, "qty", "2026-01-01T00:00:00Z", "2026-01-02T00:00:00Z", "x") in got and (2, "a", "", "2026-01-02T00:00:00Z", "") in got
    assert found(satellites.validity_view(satellites.satellite_rows(df.limit(0)))) == set()


def test_satellites_are_appended_by_rate(spark, tmp_path):
    rows = [(i, i % 7, "fast" if i % 3 else "slow", "0", str(i), "2026-01-02T00:00:00Z") for i in range(60)]
    sats = satellites.satellite_rows(spark.createDataFrame([(*r, 5, "x") for r in rows], HIST))
    satellites.append_satellites(sats, str(tmp_path / "s"))
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} <= {"satellite=fast", "satellite=medium", "satellite=slow"}
    assert found(satellites.validity_view(spark.read.parquet(str(tmp_path / "s")))) == found(satellites.validity_view(sats))


# --- drift ---

ITEM = "attachment_id long, sn string, nupco_code string, description string, uom string, qty_raw string, raw_row string, id long, label string, field string"


@with_data
def test_drift_on_tables(spark):
    items, files = table(spark, DATA, "tender_items"), table(spark, DATA, "item_files")
    rows = [r.asDict() for r in items.collect()]
    assert found(schema_drift.label_changes(items, files)) == brute.drift(rows, [tuple(r) for r in files.select("attachment_id", "feed", "file_no").collect()])


def drift_rows(files):
    """One row per file: (attachment_id, {label: value}) with the fields taken from known labels."""
    out = []
    for a, raw in files:
        text = raw if raw is None or isinstance(raw, str) else json.dumps(raw)
        named = raw if isinstance(raw, dict) else {}
        get = lambda *ks: next((brute.flat(named[k]) for k in ks if named.get(k) is not None), None)  # noqa: B023, E731
        out.append((a, get("SN", "sn."), get("Code"), get("Description", "DESC"), get("Unit"), get("Qty"), text, a * 10, "clash", "clash"))
    return out


@pytest.mark.parametrize("slice_size", [1000, 2])
def test_drift_edges(spark, monkeypatch, slice_size):
    monkeypatch.setattr(schema_drift, "SLICE", slice_size)
    files = [
        (1, {"SN": "1", "Description": "AA", "Extra": 5}), (2, {"sn.": "2", "DESC": ["A", "B"], "Extra": None}), (3, '{"SN": "3", "Desc'), (4, {"SN": 4, "Description": {"en": "ABCD"}}),
        (5, {"SN": 5, "Description": "E", "Qty": {"amount": 7.5}, "New  Label!": True}), (6, {"SN": 6, "Description": "EFG", "Qty": "8", "new label": False}), (7, None), (11, {"SN": "1"}), (12, {"SN": "2"}),
    ]
    feeds = [(a, "f", a) for a in range(1, 8)] + [(11, "g", 1), (12, "g", 2), (13, "g", 3), (99, None, 1), (98, "h", None)]
    items = spark.createDataFrame(drift_rows(files), ITEM)
    catalogue = spark.createDataFrame([(*f, "x") for f in feeds], "attachment_id long, feed string, file_no int, label string")
    plain = brute.drift([r.asDict() for r in items.collect()], [f for f in feeds if None not in f])
    got = found(schema_drift.label_changes(items, catalogue))
    assert got == plain
    assert (13, "removed", "sn") in got and (6, "retyped", "qty") in got
    assert found(schema_drift.label_changes(items.limit(0), catalogue)) == set() == found(schema_drift.label_changes(items, catalogue.limit(0)))


def test_consistent_table(spark):
    files = [(1, {"SN": "1", "Description": "AA", "Code": 4212345678901}), (2, {"sn.": 2, "DESC": ["A", "B"], "Qty": "9"}), (3, '{"SN": "3'), (4, None)]
    rows = {r["id"]: r for r in schema_drift.consistent_items(spark.createDataFrame(drift_rows(files), ITEM)).collect()}
    assert (rows[10]["nupco_code"], rows[20]["description"], rows[20]["sn"], rows[20]["qty_raw"]) == ("4212345678901", "A B", "2", "9")
    assert [rows[i]["parsed"] for i in (10, 20, 30, 40)] == [True, True, False, False]


def test_consistent_table_keeps_every_label(spark):
    files = [
        (1, {"SN": "1", "Code": 4212, "Cold Chain": ["a", "b"], "Months": 12, "Urgent": True, "ملاحظة": "x", "موقع": "y"}),
        (2, {"sn.": 2, "Code": "none", "Cold  chain!": None, "Months": "24", "Urgent": "False", "Qty": {"amount": 7.5}}),
        (3, {"SN": "3a", "Code": 77, "months": "two years", "MONTHS": 36, "Urgent": False, "Qty": "8"}), (4, '{"SN": "4'), (5, {}),
    ]
    items = spark.createDataFrame(drift_rows(files), ITEM)
    rows = {r["id"]: r for r in schema_drift.consistent_items(items.union(items)).collect()}
    assert rows[10]["others"] == {"cold chain": ["a b"], "months": ["12"], "urgent": ["true"], "ملاحظة": ["x"], "موقع": ["y"]}
    assert rows[20]["others"] == {"cold chain": [], "code": ["none"], "months": ["24"], "urgent": ["False"]}
    assert rows[30]["others"] == {"months": ["36", "two years"], "urgent": ["false"]}
    numbers = {i: {k: float(v) for k, v in r["numbers"].items()} for i, r in rows.items()}
    assert numbers == {10: {"sn": 1, "nupco_code": 4212, "months": 12}, 20: {"sn": 2, "months": 24, "qty_raw": 7.5}, 30: {"nupco_code": 77, "months": 36, "qty_raw": 8}, 40: {}, 50: {}}
    assert [rows[i]["flags"] for i in (10, 20, 30)] == [{"urgent": True}, {"urgent": False}, {"urgent": False}]
    assert [(rows[i]["others"], rows[i]["parsed"]) for i in (40, 50)] == [({}, False), ({}, True)]


@with_data
def test_no_label_value_is_lost(spark):
    """Every filled value of every parseable raw_row stands in a field or under its label."""
    items = table(spark, DATA, "tender_items")
    rows = {r["id"]: r for r in schema_drift.consistent_items(items).collect()}
    for i, raw in items.where("id IS NOT NULL").select("id", "raw_row").collect():
        try:
            named = json.loads(raw or "")
        except ValueError:
            continue
        held = {t for ts in rows[i]["others"].values() for t in ts} | {rows[i][f] for f in schema_drift.FIELDS}
        for value in named.values():
            text = "" if value is None else brute.flat(value)
            assert value is None or text in held or "".join(c for c in text if c.isdigit()) == rows[i]["nupco_code"], (i, value)


# --- units ---


@with_data
def test_units_on_tables(spark):
    items, tenders = table(spark, DATA, "tender_items"), table(spark, DATA, "tenders")
    rows = items.join(tenders.select("post_id", "source"), "post_id", "left").select("id", "uom", "qty_raw", "qty", "source").distinct().collect()
    expected = set()
    for i, uom, raw, qty, source in rows:
        got = raw and brute.amount(raw, uom, source == "joneps")
        if got and (qty is None or float(got[1]) != qty):
            expected.add((i, got[0], int(got[1])))
    assert found(units.converted_items(items)) == expected


@pytest.mark.parametrize(
    ("raw", "uom", "joneps", "expected"),
    [
        ("1,250 ML", None, False, ("ml", 1250)), ("12,5 kg", "kg", False, ("mg", 12_500_000)), ("1.250", "EA", False, ("each", 1.25)), ("1.250", "EA", True, ("each", 1250)),
        ("5 BOX X 10", None, False, ("each", 50)), ("3 BAG OF 2.5 LTR", None, False, ("ml", 7500)), ("12.5 K", "PCS", False, ("each", 12_500)), ("4 DOZEN", "DOZEN", False, ("each", 48)),
        ("7", "GROSS", False, ("each", 1008)), ("٢٬٥٠٠ ملغ", None, False, ("mg", 2500)), ("10 EACH", "EACH", False, ("each", 10)), ("2", "100'S", False, ("each", 200)), ("6", "BX24", False, ("each", 144)),
        ("9", "ROLL/4.5M", False, ("mm", 40_500)), ("8", None, False, ("each", 8)), ("5", "VIAL", False, ("each", 5)), ("2 million", "ML", False, ("ml", 2_000_000)), ("1 000 250", "mm", False, ("mm", 1_000_250)),
        ("AS PER LIST", "EA", False, None), ("", "EA", False, None), ("1.2.3", "EA", False, None), ("9" * 40, "EA", False, None), ("3 DOZEN", "BOX OF 10", False, ("each", 360)), ("4\nLTR\n", None, False, ("ml", 4000)),
    ],
)
def test_amounts(spark, raw, uom, joneps, expected):
    df = spark.createDataFrame([(1, raw, uom, "clash")], "id long, qty_raw string, uom string, alias string")
    r = units.common_amounts(df, dot_groups=F.lit(joneps)).first()
    assert (expected is None and r["base_amount"] is None) or (r["base_unit"], float(r["base_amount"])) == expected


def test_unit_rows(spark):
    schema = "id long, post_id long, uom string, qty_raw string, qty double, base_unit string"
    rows = [(1, 5, "EA", "3", 3.0, "x"), (2, 5, "DZ", "3", 3.0, "x"), (2, 5, "DZ", "3", 3.0, "x"), (3, None, None, "4", None, "x"), (None, 5, "EA", "3", None, "x"), (5, 5, "EA", None, None, "x"), (6, 5, "EA", "x" * 100_000, None, "x")]
    df = spark.createDataFrame(rows, schema)
    assert found(units.converted_items(df)) == {(2, "each", 36), (3, "each", 4)}
    assert found(units.converted_items(df.limit(0))) == set()


# --- instants ---


@with_data
def test_instants_on_tables(spark):
    tenders = table(spark, DATA, "tenders")
    fields = ("opening_date", "submission_deadline", "bid_opening")
    expected = {(r["post_id"], f, i) for r in tenders.collect() for f in fields if r[f] is not None and (i := brute.instant(r[f], r["source"]))}
    assert found(instants.field_instants(tenders)) == expected


@pytest.mark.parametrize(
    ("text", "source", "expected"),
    [
        ("Sun, 20/09/2026", "nupco", "2026-09-19T21:00:00Z"), ("2026-09-20T10:00:00.999Z", "nupco", "2026-09-20T10:00:00Z"), ("1609830007", "joneps", "2021-01-05T07:00:07Z"), ("1609830007999", "joneps", "2021-01-05T07:00:07Z"),
        ("28/10/2022 00:30", "joneps", "2022-10-27T21:30:00Z"), ("28/10/2021 23:30", "joneps", "2021-10-28T20:30:00Z"),
        ("29/10/2021 00:30", "joneps", "2021-10-28T21:30:00Z"),  # occurs twice: the earlier one
        ("26/03/2021 00:30", "joneps", "2021-03-25T22:30:00Z"),  # skipped: moves forward by the gap
        ("31/10/2021 02:30 Europe/Berlin", "nupco", "2021-10-31T00:30:00Z"), ("12/07/2021 12:15 AM", "nupco", "2021-07-11T21:15:00Z"), ("12/07/2021 12:15 م", "nupco", "2021-07-12T09:15:00Z"),
        ("04-Oct-2018 17:30 GMT+4", "nupco", "2018-10-04T13:30:00Z"), ("2018-02-08 02:00:00-0530", "nupco", "2018-02-08T07:30:00Z"), ("01/01/2024 00:00 (Amman time)", "nupco", "2023-12-31T21:00:00Z"),
        ("29/02/2024", "nupco", "2024-02-28T21:00:00Z"), ("29/02/2023", "nupco", None), ("29/02/1900", "nupco", None), ("31/04/2024", "nupco", None), ("10/10/2024 24:00", "nupco", None), ("13:00 PM", "nupco", None),
        ("10/10/2024 13:00 PM", "nupco", None), ("TBA", "nupco", None), ("", "nupco", None), (None, "nupco", None), ("10/10/2024", None, None), ("10/10/2024 10:00Z", None, "2024-10-10T10:00:00Z"),
        ("10/10/2024 10:00 Mars/Base", "nupco", None), ("x" * 200_000, "nupco", None), ("14/07/2024 14:00 America/New_York", "nupco", "2024-07-14T18:00:00Z"),
    ],
)
def test_instant(spark, text, source, expected):
    df = spark.createDataFrame([(text, source)], "t string, s string")
    assert df.select(instants.utc_instant(F.col("t"), F.col("s"))).first()[0] == expected


def test_instants_do_not_hang_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        df = spark.createDataFrame([("20/09/2026 10:00", "nupco")], "t string, s string")
        assert df.select(instants.utc_instant(F.col("t"), F.col("s"))).first()[0] == "2026-09-20T07:00:00Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_instants_of_long_texts(spark):
    """Padding of any length, long digits and long rubbish."""
    texts = [" " * 500 + "05/03/2026 10:00 " + "\t" * 300, "1" * 400, "5/3/2026 " + "x" * 100_000, "1772700000123456789", "99", " 1772700000 ", "|" * 14, ""]
    df = spark.createDataFrame([(i, t, "nupco") for i, t in enumerate(texts)], "post_id long, opening_date string, source string")
    got = {r["post_id"]: r["instant_utc"] for r in instants.field_instants(df, ("opening_date",)).collect()}
    assert got == {0: "2026-03-05T07:00:00Z", 3: "2026-03-05T08:40:00Z", 4: "1970-01-01T00:01:39Z", 5: "2026-03-05T08:40:00Z"}

"""Upsert, versions, marts, discovery, search, runs and the stream."""

import json

from pyspark.sql import functions as F

from bidloom.operators import discovery, marts, runs, search, upsert, versions
from bidloom.streaming import feed

STORED = "post_id long, tender_id string, status_label string, item_count double, is_listed int, source string, first_seen_at string, last_seen_at string, last_changed_at string"


def stored(spark):
    rows = [(1, "T1", "Open", 3.0, 1, "nupco"), (2, "T2", "Open", 4.0, 1, "nupco"), (3, "T3", None, None, 0, "joneps"), (4, "T4", "Open", 1.0, 1, None)]
    return spark.createDataFrame([(*r, "d0", "d0", "d0") for r in rows], STORED)


def test_upsert_and_history(spark):
    new = spark.createDataFrame(
        [(1, "T1", "Open", "3", 1), (2, "T2", "Closed", None, 0), (3, "T3", "", None, 1), (9, "T9", "Open", "1", 1), (9, "T9", "Open", "1", 1), (None, "x", "y", "1", 1)],
        "post_id long, tender_id string, status_label string, item_count string, is_listed int",
    )
    result = upsert.upsert(stored(spark), new, "d1", 5)
    state = {r["post_id"]: r["state"] for r in result.collect()}
    assert state == {1: "same", 2: "changed", 3: "changed", 4: "kept", 9: "new"}
    log = {tuple(r) for r in upsert.history_rows(result).select("post_id", "field", "old_value", "new_value", "change_kind").collect()}
    assert log == {(2, "status_label", "Open", "Closed", "update"), (2, "item_count", "4.0", None, "update"), (2, "is_listed", "1", "0", "delist"), (3, "is_listed", "0", "1", "relist"), (9, "_record", None, "T9", "new")}
    table = upsert.new_state(result)
    rows = {r["post_id"]: r for r in table.collect()}
    assert (rows[1]["last_seen_at"], rows[1]["last_changed_at"], rows[2]["last_changed_at"], rows[4]["last_seen_at"], rows[9]["first_seen_at"]) == ("d1", "d0", "d1", "d0", "d1")
    again = upsert.upsert(table, new, "d2", 6)
    assert {r["state"] for r in again.where("post_id <> 4").collect()} == {"same"} and upsert.history_rows(again).count() == 0


def test_upsert_writes_only_present_fields(spark):
    new = spark.createDataFrame([(1, None, "Shut", ["status_label"]), (2, None, None, ["tender_id", "status_label"])], "post_id long, tender_id string, status_label string, present array<string>")
    rows = {r["post_id"]: r for r in upsert.new_state(upsert.upsert(stored(spark), new, "d1", 5)).collect()}
    assert (rows[1]["tender_id"], rows[1]["status_label"], rows[2]["tender_id"], rows[2]["status_label"]) == ("T1", "Shut", None, None)


def test_delist_only_own_source_after_a_complete_crawl(spark):
    seen = spark.createDataFrame([(1,), (None,)], "post_id long")
    table, log = upsert.delist_unseen(stored(spark), seen, "nupco", "d1", 5, complete=True)
    assert {r["post_id"]: r["is_listed"] for r in table.collect()} == {1: 1, 2: 0, 3: 0, 4: 0} and {r["post_id"] for r in log.collect()} == {2, 4}
    table, log = upsert.delist_unseen(stored(spark), seen, "nupco", "d1", 5, complete=False)
    assert log.count() == 0 and table.where("post_id = 2").first()["is_listed"] == 1


def test_versions(spark):
    seen = spark.createDataFrame([(1, 7, "r", "a", "t1"), (2, 7, "r", "a", "t2"), (3, 7, "r", None, "t3"), (4, 7, "r", "a", "t4"), (5, 8, "r", None, "t1")], "id long, post_id long, role string, content_sha256 string, seen_at string")
    got = {(r["post_id"], r["version"]): (r["content_sha256"], r["first_seen_at"], r["last_seen_at"], r["first_of_key"], r["is_current"]) for r in versions.number_versions(seen).collect()}
    assert got == {(7, 1): ("a", "t1", "t2", "t1", 0), (7, 2): (None, "t3", "t3", "t1", 0), (7, 3): ("a", "t4", "t4", "t1", 1), (8, 1): (None, "t1", "t1", "t1", 1)}
    files = spark.createDataFrame([(1, 7, "r", 1, "u"), (2, 7, "r", 2, "u"), (3, 7, "r", 2, "v")], "id long, post_id long, role string, version int, url string")
    assert versions.current_versions(files).first()["id"] == 3


def test_sliced_versions_equal_plain(spark):
    rows = [(i, 7, "r", None if i % 50 == 0 else str(i // 4 % 6), f"2026-01-{1 + i % 9:02d}T00:{i % 60:02d}:00Z") for i in range(500)] + [(900 + i, i, "r", "a", "2026-01-01T00:00:00Z") for i in range(20)]
    seen = spark.createDataFrame(rows, "id long, post_id long, role string, content_sha256 string, seen_at string")
    got = {least: {tuple(r) for r in versions.number_versions(seen, least=least).collect()} for least in (10_000, 30)}
    assert got[30] == got[10_000] and len(got[30]) > 100


def test_document_states(spark):
    old = spark.createDataFrame([(1, "r", "a", 2, 1, "t0", "t1"), (2, "r", "a", 1, 1, "t0", "t1"), (3, "r", "a", 1, 1, "t0", "t1")], "post_id long, role string, content_sha256 string, version int, is_current int, first_seen_at string, last_seen_at string")
    new = spark.createDataFrame([(1, "r", "b"), (2, "r", "a"), (4, "r", "c")], "post_id long, role string, content_sha256 string")
    got = {r["post_id"]: (r["state"], r["version"], r["last_seen_at"]) for r in versions.document_states(old, new, "t9").collect()}
    assert got == {1: ("changed", 3, "t9"), 2: ("same", 1, "t9"), 3: ("kept", 1, "t1"), 4: ("new", 1, "t9")}


def test_reconcile_takes_the_cheapest_signal(spark):
    schema = "post_id long, role string, url string, etag string, http_last_modified string, size_bytes long, content_sha256 string"
    old = spark.createDataFrame([(i, "r", "u", "e", None, 5, "h") for i in range(1, 7)], schema)
    new = spark.createDataFrame(
        [(1, "r", "u", "e", "m", None, None, None), (2, "r", "u", None, "m", None, "h", None), (3, "r", "v", "e", None, 5, "x", None), (4, "r", "u", "z", None, 5, None, None), (5, "r", "u", "e", None, 5, None, "timeout"), (9, "r", "u", None, None, None, "h", None)],
        schema + ", error string",
    )
    got = {r["post_id"]: r["state"] for r in versions.reconcile(old, new).collect()}
    assert got == {1: "same", 2: "same", 3: "changed", 4: "error", 5: "error", 9: "new"}
    counts = versions.file_counts(versions.reconcile(old, new).withColumn("role", F.lit("Tender Item List"))).where("post_id = 3").first()
    assert (counts["checked"], counts["changed"]) == (1, 1)


def test_audit(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"abc")
    archive = spark.read.format("binaryFile").load(str(tmp_path))
    path = archive.first()["path"]
    right = archive.select(F.sha2("content", 256)).first()[0]
    rows = [(1, path, 3, right), (2, path, 4, right), (3, path, 3, "00"), (4, "gone", 3, right), (5, path, None, None), (6, None, 1, "x")]
    got = {r["id"]: r["verdict"] for r in versions.audit(spark.createDataFrame(rows, "id long, local_path string, size_bytes long, content_sha256 string"), archive).collect()}
    assert got == {1: "ok", 2: "wrong size", 3: "wrong hash", 4: "missing", 5: "ok"}


def test_search_is_safe_and_ranked(spark):
    df = spark.createDataFrame([(1, "insulin pen, insulin needles"), (2, "insulin"), (3, None), (4, "NPT0462/26 أنسولين"), (None, "insulin")], "id long, text string")
    got = [r["id"] for r in search.search(df, "id", F.col("text"), "INSUL").orderBy(F.desc("score")).collect()]
    assert set(got) == {1, 2}
    assert [r["id"] for r in search.search(df, "id", F.col("text"), "npt0462").collect()] == [4] == [r["id"] for r in search.search(df, "id", F.col("text"), "أنسو").collect()]
    for hostile in ('"', "a OR b", "'; DROP TABLE x; --", "*", "", None, "%_", "insulin\"*", "NEAR(a b)"):
        search.search(df, "id", F.col("text"), hostile).collect()
    assert search.search(df, "id", F.col("text"), "").count() == 4
    index = search.postings(df, "id", F.col("text"))
    stats = df.where("id is not null").select(F.avg(F.size(search.words(F.col("text"))))).first()[0]
    a = {r["id"]: round(r["score"], 9) for r in search.search_index(index, "id", "insulin ne", 4, stats).collect()}
    b = {r["id"]: round(r["score"], 9) for r in search.search(df, "id", F.col("text"), "insulin ne").collect()}
    assert a == b and set(a) == {1}


def test_index_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "b a b")], "id long, text string")
    search.write_index(df, "id", F.col("text"), str(tmp_path / "i"))
    assert {(r["term"], r["tf"], r["dl"]) for r in spark.read.parquet(str(tmp_path / "i")).collect()} == {("a", 1, 3), ("b", 2, 3)}


def test_discovery(spark):
    cards = spark.createDataFrame([(1, "https://x/T/A%20b/"), (2, "https://x/c"), (3, None)], "post_id long, url string")
    site = spark.createDataFrame([("https://x/t/a b", "m1"), ("https://x/d", None)], "url string, lastmod string")
    assert {(r["post_id"], r["lastmod"], r["via"]) for r in discovery.found_tenders(cards, site).collect()} == {(1, "m1", "both"), (2, None, "grid"), (None, None, "sitemap")}
    passes = [(1, 2024, 1, True, "Opened", None, "t"), (1, 2024, 2, True, "EP0034", "S1", "u"), (1, 2025, 1, True, "Final_Awarded", "S2", "v"), (2, 2025, 1, True, "x", None, None), (3, 2026, 1, True, "x", None, None), (None, 2026, 2, False, None, None, None)]
    got = {r["post_id"]: (r["labels"], r["status"], r["subcategory"], r["title"]) for r in discovery.merged_passes(spark.createDataFrame(passes, "post_id long, year int, pass_no int, ok boolean, label string, subcategory string, title string")).collect()}
    assert got == {1: (["EP0034", "Final_Awarded", "Opened"], "Final_Awarded", "S1", "t"), 2: (["x"], None, None, None)}
    one = spark.createDataFrame([("", "detail", None)], "c string, d string, e string")
    o = discovery.overlay({"a": F.col("c")}, {"a": F.col("d"), "b": F.col("d")})
    assert tuple(one.select(o["a"], o["b"]).first()) == ("detail", "detail")
    f = spark.createDataFrame([("d", True, False, False), (None, True, False, False), ("d", True, True, False), ("d", True, True, True)], "fetched string, same boolean, awarded boolean, has boolean")
    assert [r[0] for r in f.select(discovery.frozen(False, F.col("fetched"), F.col("same"), F.col("awarded"), F.col("has"))).collect()] == [True, False, False, True]


def test_pages_and_filters(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 5.0, "B%"), (3, 7.0, None), (4, 7.0, "a")], "id long, qty double, name string")
    order = marts.pick_sort("qty_desc", marts.SORTS, False)
    assert [r["id"] for r in marts.page(df, order, "id", 10).collect()] == [3, 4, 2, 1] and [r["id"] for r in marts.page(df, order, "id", 2, 1).collect()] == [4, 2]
    assert marts.page(df, order, "id", -5).count() == 0 and marts.pick_sort("relevance", marts.SORTS, True) is None and marts.pick_sort("nonsense", marts.SORTS, True) == marts.SORTS["opening_desc"]
    assert [r["id"] for r in df.where(marts.text_filter(["name"], "b%")).collect()] == [2] and df.where(marts.text_filter(["name"], "% _ -")).count() == 4


def test_group_summary_median(spark):
    df = spark.createDataFrame([("k", 1.0, "m", 2.0, 1, "d1"), ("k", 4.0, None, None, 0, "d3"), ("k", None, "a", 1.0, None, None), ("j", None, None, None, None, None), (None, 1.0, "m", 1.0, 1, "d")], "k string, v double, n string, a double, f int, d string")
    c = F.col
    k, j = marts.group_summary(df, c("k"), c("v"), c("n"), c("a"), c("f"), c("d")).collect()
    assert (k["lines"], k["min_value"], k["median_value"], k["max_value"], k["names"], k["amount"], k["flagged"], k["unflagged"], k["unknown"], k["latest"]) == (3, 1.0, 2.5, 4.0, "a,m", 3.0, 1, 1, 1, "d3")
    assert j["median_value"] is None and j["names"] == ""


def test_runs(spark):
    events = [(1, "full", "2026-01-01T00:00:00Z", None, "running", "a", '{"progress": "1/2"}'), (1, "full", "2026-01-01T00:00:00Z", "2026-01-01T01:00:00Z", "ok", "b", None), (2, "inc", "2026-01-02T00:00:00Z", None, "running", "a", "broken")]
    df = spark.createDataFrame(events, "run_id int, mode string, started_at string, finished_at string, status string, event_at string, notes string")
    got = {r["run_id"]: (r["status"], r["progress"]) for r in runs.run_states(df, "2026-01-02T07:00:00Z").collect()}
    assert got == {1: ("ok", None), 2: ("abandoned", None)} and {r["status"] for r in runs.run_states(df, "2026-01-02T05:00:00Z").collect()} == {"ok", "running"}


def test_stream_keeps_a_table_current(spark, tmp_path):
    schema = stored(spark).schema
    records = [[{"post_id": 1, "tender_id": "T1", "status_label": "Open", "is_listed": 1}], [{"post_id": 1, "tender_id": "T1", "status_label": "Closed", "is_listed": 1}, {"post_id": 2, "tender_id": "T2", "status_label": "Open", "is_listed": 1}]]
    (tmp_path / "in").mkdir()
    for n, batch in enumerate(records):
        (tmp_path / f"in/{n}.json").write_text("\n".join(map(json.dumps, batch)))
        stream = feed.record_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], "post_id long, tender_id string, status_label string, is_listed int").schema, 1)
        feed.keep_current(stream, str(tmp_path / "t"), str(tmp_path / "h"), str(tmp_path / "c"), schema).awaitTermination()
    state = {r["post_id"]: r["status_label"] for r in spark.read.parquet(str(tmp_path / "t/state=2")).collect()}
    log = {(r["post_id"], r["field"], r["change_kind"]) for r in spark.read.parquet(str(tmp_path / "h")).collect()}
    assert state == {1: "Closed", 2: "Open"} and log == {(1, "_record", "new"), (1, "status_label", "update"), (2, "_record", "new")}


def test_windowed_stream_drops_late_rows(spark, tmp_path):
    rows = spark.createDataFrame([("2026-01-01 10:05:00", "a", 1.0), ("2026-01-01 10:50:00", "a", 2.0), ("2026-01-01 14:00:00", "b", 5.0)], "ts string, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.coalesce(1).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "e"))
    q = feed.windowed_counts(stream).writeStream.format("memory").queryName("w").outputMode("append").start()
    q.processAllAvailable()
    q.stop()
    assert [(r["event_type"], r["n"], r["total"]) for r in spark.sql("SELECT * FROM w").collect()] == [("a", 2, 3.0)]


def test_slices_follow_the_rows_not_their_range(spark):
    """Outliers, unreadable instants and one instant of many rows leave no slice of a hot key with most of its rows."""
    from bidloom.skew import with_slices

    rows = [(1, 1000 + i // 7, i) for i in range(5000)] + [(1, -(2**62), 10**6 + i) for i in range(2000)] + [(1, 10**15, 7), (1, 5000, None)] + [(2, 5, i) for i in range(50)]
    out, sliced = with_slices(spark.createDataFrame(rows, "k long, o long, t long"), ["k"], "o", "t", least=100)
    numbers = [r["slice_no"] for r in out.where("k = 1").orderBy("o", F.col("t").asc_nulls_first()).collect()]
    assert sliced and numbers == sorted(numbers) and max(numbers) < 256
    assert max(numbers.count(n) for n in set(numbers)) < len(numbers) / 40
    assert {r["slice_no"] for r in out.where("k = 2").collect()} == {0}


def test_versions_of_a_hot_key_with_outliers(spark):
    import random

    from bidloom.operators import versions

    rnd = random.Random(3)
    rows = [(1, "r", i, rnd.choice("aab"), f"2026-01-{1 + i % 28:02d}T{i % 24:02d}:00:00Z") for i in range(300)] + [(1, "r", 900, "z", "9999-12-31T00:00:00Z"), (1, "r", 901, "y", "not a time"), (2, "r", 5, "q", None)]
    df = spark.createDataFrame(rows, "post_id long, role string, id long, content_sha256 string, seen_at string")
    plain, sliced = (
        sorted(map(str, versions.number_versions(df, least=least).select("post_id", "role", "version", "content_sha256", "is_current").collect())) for least in (10_000, 20)
    )
    assert plain == sliced and len(plain) > 50


def test_search_pages_and_tender_pages(spark):
    rows = spark.createDataFrame(
        [(1, "pharma", "Open", 0, 0, 5, "2026-01-01", "2026-02-01", None), (2, "pharma", "Open", 0, 1, None, None, None, "JO"), (3, "lab", None, 1, None, -1, "2026-01-03", None, "SA")],
        "id long, category_guess string, status_label string, is_terminal int, is_accessory int, days_to_deadline int, opening_ts string, submission_ts string, country string",
    )
    scores = spark.createDataFrame([(1, 0.5), (2, 0.9), (3, 0.5)], "id long, score double")
    page = lambda *a, **k: [(r["id"], r["total"]) for r in marts.search_page(rows, *a, **k).collect()]
    assert page(scores, "id") == [(2, 3), (1, 3), (3, 3)] and page(scores, "id", limit=1, offset=1) == [(1, 3)]
    assert page(scores, "id", "deadline_asc", category="pharma") == [(1, 2), (2, 2)] and page(scores, "id", hide_accessories=True) == [(1, 1)]
    assert page(None, "id") == [(3, 3), (1, 3), (2, 3)] == page(None, "id", "nonsense") and page(scores.limit(0), "id") == [] and page(scores, "id", offset=9) == []
    tenders = spark.createDataFrame([(1, "T", "x"), (2, None, None)], "post_id long, tender_id string, title_en string")
    files = spark.createDataFrame([(7, 1, "b", "f", 1, 1), (7, 1, "b", "f", 1, 1), (8, 1, None, None, 2, 1), (9, 1, "c", "old", 1, 0)], "id long, post_id long, role string, filename string, version int, is_current int")
    items = spark.createDataFrame([(k, 1, 7, None, 10 - k, "d", 1.0) for k in range(5)] + [(0, 1, 7, None, 10, "d", 1.0), (20, 1, 9, 1, 1, "retired", 1.0)], "id long, post_id long, attachment_id long, source_page int, row_index int, description string, qty double")
    history = spark.createDataFrame([(1, 1, "f", "a", "b", "2026-01-01T00:00:00+03:00"), (2, 1, "f", "b", "c", "broken"), (3, 1, "f", "c", "d", "2026-01-01T00:00:00Z")], "id long, post_id long, field string, old_value string, new_value string, changed_at string")
    awards = spark.createDataFrame([(1, "2", 1, "z", None), (1, "1", 9, None, 2.5)], "post_id long, award_no string, item_no int, beneficiary string, unit_cost double")
    a, b = marts.tender_page(tenders, files, items, history, awards, most_items=3).orderBy("post_id").collect()
    assert [f["id"] for f in a["files"]] == [8, 7] and a["item_total"] == 5 and [i["id"] for i in a["items"]] == [4, 3, 2]
    assert [h["id"] for h in a["changes"]] == [3, 1, 2] and [w["award_no"] for w in a["awards"]] == ["1", "2"]
    assert (b["files"], b["item_total"], b["items"], b["changes"], b["awards"]) == ([], 0, [], [], [])

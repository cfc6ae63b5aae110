"""Portal pages, JSON, files and lines on made-up inputs."""

import csv
import io
import zipfile

from pyspark.sql import functions as F

from bidloom import schemas
from bidloom.sources import lines, portal_html, portal_json, sinks, tables, tabular


def pages(spark, *html):
    return spark.createDataFrame(list(enumerate(html)), "page_id int, html string")


def test_list_rows_and_counters(spark):
    go = "fn_goDetail( '77', '2', '1', 'EP1', 'B', '7', 'EP0021', 'EP0016' )"
    row = f"<tr><td><a onclick=\"{go}\">77</a></td><td>A &amp; B</td><td> Royal<br>Stores</td><td>M</td><td>03/02/2026 10:00</td><td>31/13/2026</td></tr>"
    html = f'<span class="pointTxt2"> 1.045 </span> النتائج الصفحة <span>1</span>/1.011<table>{row}<tr><td>no call</td></tr><tr><td onclick="{go}">short</td></tr></table>'
    df = pages(spark, html, None, "")
    (r,) = portal_html.list_rows(df).collect()
    assert (r["tend_no"], r["tend_seq"], r["type"], r["title"], r["buyer"], r["published"], r["deadline"]) == ("77", "2", "EP0016", "A & B", "Royal Stores", "2026-02-03", "2026-13-31")
    counts = df.select(portal_html.list_total(F.col("html")), portal_html.list_pages(F.col("html"))).collect()
    assert [tuple(c) for c in counts] == [(1045, 1011), (None, None), (None, None)]


def test_first_seen_and_award_refs(spark):
    df = spark.createDataFrame([(1, 2, 0, "late"), (1, 1, 5, "first"), (2, 1, 1, "x")], "k int, page int, position int, v string")
    assert {(r["k"], r["v"]) for r in portal_html.first_seen(df, ["k"], ["page", "position"]).collect()} == {(1, "first"), (2, "x")}
    html = "fn_goDetailAwrdDcsion('5','1') fn_goDetailAwrdDcsionMd('6','') fn_goDetailAwrdDcsion('5','1')"
    assert pages(spark, html).select(portal_html.award_refs(F.col("html"))).first()[0] == ["5,1", "6,"]


def test_cards_sitemap_details(spark):
    card = '<div class="e-loop-item post-9 tender-status-cancelled tender-status-hidden"><a href="/t/9">x</a><div data-id="w1"><h2> T <b>9</b></h2></div></div>'
    (c,) = portal_html.cards(pages(spark, f"<main>{card}<div class='e-loop-item'>none</div></main>", None), {"tender_id": "w1"}).collect()
    assert (c["post_id"], c["status_slugs"], c["url"], c["tender_id"]) == (9, ["cancelled", "hidden"], "/t/9", "T 9")
    xml = "<url><loc> https://x/tender/a </loc><lastmod>2026-01-01</lastmod></url><url><loc>https://x/page</loc></url><url><loc>https://x/tender/b</loc></url>"
    assert {tuple(r) for r in portal_html.sitemap_urls(pages(spark, xml)).collect()} == {("https://x/tender/a", "2026-01-01"), ("https://x/tender/b", None)}
    head = lambda t: f'<div data-widget_type="heading.default"><h3>{t}</h3></div>'
    parts = ["Tender ID", "NPT1/26", "Open", "Opening Date:", "01/02/2026", "Tender Booklet Price", "SAR 1,500", "a title of more than 25 letters", "another long title of the tender"]
    button = '<a class="elementor-button x" href="/f/1.pdf"><span>Tender Item List</span></a>'
    (d,) = portal_html.details(pages(spark, f'<html lang="ar-SA"><body class="a postid-55 b">{"".join(map(head, parts))}{button}</body></html>')).collect()
    assert (d["post_id"], d["lang"], d["tender_id"], d["status_label"], d["opening_date"], d["booklet_price_sar"]) == (55, "ar", "NPT1/26", "Open", "01/02/2026", 1500.0)
    assert d["title_ar"].startswith("a title") and d["title_en"].startswith("another") and d["attachments"] == {"Tender Item List": "/f/1.pdf"}
    assert portal_html.details(pages(spark, "")).first()["tender_id"] is None


def test_label_values_and_links(spark):
    html = "<table><tr><th>A</th><td>1</td><th>B</th><th>C</th><td></td></tr><tr><th>A</th><td>2</td></tr></table><ul><li><a href='/x'>go <i>on</i></a></ul>"
    assert {tuple(r) for r in portal_html.label_values(pages(spark, html, None)).collect()} == {(0, "A", "1"), (0, "C", "")}
    assert [tuple(r) for r in portal_html.links(pages(spark, html)).collect()] == [(0, 0, "/x", "go on")]


def award_page(price="السعر النهائي شامل الضريبة", blocks=1):
    head = "<table><tr><th>رقم قرار الإحالة</th><td>A-7</td><th>حالة الإحالة</th><td>Final</td></tr><tr><th>تاريخ نشر قرار الاحالة</th><td>5/3/2026</td><th>الجهة المشترية</th><td>[27] Royal</td></tr></table>"
    who = "<table><tr><th>رقم المناقص</th><td>S1</td><th>اسم المناقص</th><td>Maker Co</td></tr><tr><th>الجهة المستفيدة</th><td>[270] Clinic</td><th>البلد</th><td>JO</td></tr></table>"
    first = ["1", "5114", "08-03", "30 tab", "", "0", "2.5", "1,080", "6,840 JOD", "lowest"]
    rows = [first, ["off", "[ Drug ]", "", "190 [USD]"], ["Maker", "JO", "2y", "Brand"]]
    body = "".join(f"<tr>{''.join(f'<td>{c}</td>' for c in r)}</tr>" for r in rows) + "<tr><th>شروط خاصة</th><td>cold</td></tr><tr><td>2</td>" + "<td></td>" * 9 + "</tr>"
    return head + (who + f"<table><tr><th>رمز UNSPSC</th><th>{price}</th></tr>{body}</table>") * blocks


def test_award_pages(spark):
    df = pages(spark, award_page(), award_page("السعر النهائي غير شامل", 2), award_page("x"), None, "<table>")
    rows = portal_html.award_rows(df).collect()
    assert [sum(r["page_id"] == p for r in rows) for p in range(5)] == [2, 4, 2, 0, 0]
    r = rows[0]
    assert (r["award_no"], r["published_at"], r["buyer"], r["beneficiary_code"], r["beneficiary"], r["supplier"]) == ("A-7", "2026-03-05", "Royal", "270", "Clinic", "Maker Co")
    assert (r["rdl_code"], r["pack_size"], r["awarded_qty"], r["total_value"], r["currency"], r["unit_price"]) == ("0803", 30.0, 1080.0, 6840.0, "JOD", 190.0)
    assert (r["scientific_name"], r["brand"], r["conditions"], r["unit_cost"], r["price_incl_tax"]) == ("Drug", "Brand", "cold", 6840 / 1080, 1)
    assert rows[1]["unit_cost"] is None and {x["price_incl_tax"] for x in rows if x["page_id"] == 1} == {0} and {x["price_incl_tax"] for x in rows if x["page_id"] == 2} == {None}


def test_drug_lines(spark):
    payload = '{"total": 2, "list": [{"lotSerno": "1", "clId": " 51142", "clNmEn": "EN", "rdlItemCd": "08-03", "totlQty": 1080, "totlQtyStr": "1.080", "details": [{"deNo": "D1", "abbrNm": "RMS", "totlQty": 5}, {"deNo": "D2", "totlQty": 0}]}, {"clNmAr": "ع"}]}'
    df = spark.createDataFrame([(1, payload), (2, "broken {"), (3, None), (4, '{"list": null}')], "post_id long, payload string")
    a, b = portal_json.drug_lines(df).orderBy("row_index").collect()
    assert (a["sn"], a["item_no"], a["description"], a["rdl_code"], a["unspsc"], a["code_group"], a["category_guess"], a["qty"]) == ("1", "1", "EN", "0803", "51142", "51", "pharma", 1080.0)
    assert [tuple(x) for x in a["demand"]] == [("D1", "RMS", 5.0)] and b["demand"] is None and (b["item_no"], b["description"]) == ("2", "ع")


def workbook(sheets):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        words = sorted({c for rows in sheets for r in rows for c in r if isinstance(c, str)})
        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{w}</t></si>" for w in words) + "</sst>")
        z.writestr("xl/externalLinks/externalLink1.xml", "not xml at all")
        for n, rows in enumerate(sheets, 1):
            cell = lambda c, at: "" if c is None else (f'<c r="{at}" t="s"><v>{words.index(c)}</v></c>' if isinstance(c, str) else f'<c r="{at}"><v>{c}</v></c>')  # noqa: B023, E731
            body = "".join(f'<row r="{i}">' + "".join(cell(c, f"{chr(65 + k)}{i}") for k, c in enumerate(r)) + "</row>" for i, r in enumerate(rows, 1))
            z.writestr(f"xl/worksheets/sheet{n}.xml", f"<worksheet {ns}><sheetData>{body}</sheetData></worksheet>")
    return out.getvalue()


def text_file(rows, delimiter=";", encoding="utf-8"):
    out = io.StringIO()
    csv.writer(out, delimiter=delimiter).writerows(rows)
    return out.getvalue().encode(encoding)


def test_files_to_items(spark):
    listing = [["Tender list"], ["SN", "Code", "Item Description", "UOM", "Requested Qty"], ["1", "4212345678901", "GLOVE, LATEX", "EA", "1,000"], ["2", "", "SYRINGE; 5ML", "EA", "7"], ["", "", "x", "", ""], ["SN", "Code", "Item Description", "UOM", "Qty"]]
    unlabelled = [["Material Number", "??", "No."], *[[f"51123456789{i:02d}", f"A LONG PRODUCT TEXT {i}", str(i)] for i in range(4)]]
    files = [
        (1, "a.csv", text_file(listing)), (2, "b.xlsx", workbook([unlabelled, [[None, "no header"]]])), (3, "c.txt", text_file([["Description", "Qty"], ["قفاز طبي", "4"]], ",", "cp1256")),
        (4, "d.xls", bytes.fromhex("D0CF11E0") + b"old"), (5, "e.xlsx", b"PK\x03\x04broken"), (6, "f.csv", b""), (7, "g.bin", b"??"), (8, "h.csv", workbook([listing])),
    ]
    rows = tabular.file_rows(spark.createDataFrame(files, "file_id int, name string, content binary"))
    good, bad = sinks.dead_letters(rows, "2026-01-01", 3)
    assert {r["file_id"] for r in bad.collect()} == {4, 5, 7} and all(len(r["reason"]) <= 500 for r in bad.collect())
    items = {(r["file_id"], r["row_index"]): r for r in tabular.sheet_items(good).collect()}
    assert sorted(items) == [(1, 2), (1, 3), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (8, 2), (8, 3)]
    a = items[1, 2]
    assert (a["sn"], a["nupco_code"], a["description"], a["uom"], a["qty"], a["qty_raw"], a["code_group"], a["category_guess"]) == ("1", "4212345678901", "GLOVE, LATEX", "EA", 1000.0, "1,000", "42", "device")
    assert items[2, 2]["description"] == "A LONG PRODUCT TEXT 1" and items[2, 2]["nupco_code"] == "5112345678901" and items[3, 1]["description"] == "قفاز طبي"
    status = {r["file_id"]: (r["parse_status"], r["parse_rows"]) for r in sinks.parse_status(spark.createDataFrame(files, "file_id int, name string, content binary"), tabular.sheet_items(good), bad).collect()}
    assert status[1] == ("parsed", 2) and status[4] == ("failed", 0) and status[6] == ("pending", 0)


def test_header_aliases(spark):
    labels = ["Item Description", "SAP  Code", "Org. Open Quantity", "U.O.M", "", None, "items name"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in labels], "l string").select(tabular.header_field(F.col("l"))).collect()]
    assert got[0] == "description" and got[1] == "nupco_code" or got[1] is None
    assert got[2] == "qty" and got[4] is None and got[5] is None and got[6] == "sn"


def test_lines_to_items(spark):
    texts = [
        (1, 0, "SN CODE DESCRIPTION UOM QTY"), (1, 1, "1. 4212345678901 GLOVE LATEX EACH ITEMIZED 1,200"), (1, 2, "POWDER FREE, size 7"), (1, 3, "Page 1 of 2"), (2, 0, "continues here BOX 5"), (2, 1, "12"), (2, 2, "4212345678902 X"),
        (2, 3, "3) 4212345678903 SUTURE PACK 9"),
    ]
    df = spark.createDataFrame([(7, p, n, t) for p, n, t in texts], "file_id int, page int, line_no int, text string")
    a, b = lines.line_items(df, words=None).orderBy("source_page", "row_index").collect()
    assert (a["sn"], a["nupco_code"], a["uom"], a["itemized"], a["qty_raw"], a["qty"]) == ("1", "4212345678901", "EACH", "ITEMIZED", "1,200", 1200.0)
    assert a["description"].startswith("GLOVE LATEX POWDER FREE, size") and a["description"].endswith("continues here")
    assert (b["sn"], b["description"], b["uom"], b["qty"]) == ("3", "SUTURE", "PACK", 9.0)
    assert lines.line_items(df.limit(0), words=None).count() == 0


def test_words_to_lines(spark):
    words = [(1, 1, 50.0, 60.0, 10.0, "world"), (1, 1, 10.0, 40.0, 12.9, "hello"), (1, 1, 10.0, 20.0, 15.0, "next"), (1, 1, None, None, None, "lost")]
    df = spark.createDataFrame(words, "file_id int, page int, x0 double, x1 double, top double, text string")
    assert [r["text"] for r in lines.visual_lines(df).orderBy("line_no").collect()] == ["hello world", "next"]
    head = spark.createDataFrame([([(0.0, 20.0, "NUPCO"), (25.0, 40.0, "CODE"), (80.0, 100.0, "DESCRIPTION"), (200.0, 210.0, "QTY")],)], "w array<struct<x0 double, x1 double, text string>>")
    cols = head.select(lines.header_columns(F.col("w"))).first()[0]
    assert [(c["field"], c["left"], c["right"]) for c in cols] == [("nupco_code", 0.0, 60.0), ("description", 60.0, 150.0), ("qty", 150.0, 10_000.0)]


def test_ruled_tables_carry_headers(spark):
    rows = [(1, 1, 0, 0, ["x"]), (1, 1, 0, 1, ["Code", "Description"]), (1, 1, 0, 2, ["1", "A"]), (1, 2, 0, 0, ["2", "B"]), (2, 1, 0, 0, ["no", "head"])]
    df = spark.createDataFrame(rows, "file_id int, page int, table_no int, row_index int, cells array<string>")
    assert sorted(tuple(r["cells"]) for r in lines.table_rows(df).collect()) == [("1", "A"), ("2", "B")]
    layer = spark.createDataFrame([(1, 1, "x" * 60), (2, 1, None), (2, 2, "few")], "file_id int, page int, text string")
    assert {tuple(r) for r in lines.text_layer(layer).collect()} == {(1, True), (2, False)}


def test_conform_and_sinks(spark, tmp_path):
    odd = spark.createDataFrame([("5", "x", 1, "note")], "POST_ID string, title_en string, is_listed int, extra string")
    out = schemas.conform(odd, "tenders")
    assert out.schema.fieldNames() == schemas.TENDERS.fieldNames() and out.first()["post_id"] == 5 and out.first()["country"] == "SA" and out.first()["item_count"] == 0
    path = str(tmp_path / "items")
    rows = lambda n, v: spark.createDataFrame([(k, i, v) for k in n for i in range(3)], "attachment_id long, i int, v string")
    sinks.replace_parts(rows([1, 2, 3], "old"), path, "attachment_id", 4)
    sinks.replace_parts(rows([2], "new").limit(1), path, "attachment_id", 4)
    left = spark.read.parquet(path).groupBy("attachment_id", "v").count().collect()
    assert {tuple(r) for r in left} == {(1, "old", 3), (2, "new", 1), (3, "old", 3)}
    spark.createDataFrame([(1, "/abs/x")], "id long, local_path string").write.parquet(str(tmp_path / "snap/attachments.parquet"))
    made = sinks.seed(spark, str(tmp_path / "snap"), str(tmp_path / "db"))
    got = spark.read.parquet(made["attachments"]).first()
    assert (got["id"], got["local_path"], got["version"]) == (1, None, 1) and spark.read.parquet(made["awards"]).count() == 0


def test_table_sources(spark, tmp_path):
    spark.createDataFrame([(1, "A")], "post_id long, tender_id string").write.parquet(str(tmp_path / "snap/tenders.parquet"))
    assert tables.snapshot(spark, str(tmp_path / "snap"), "tenders").first()["country"] == "SA"
    for n in (1, 2):
        sinks.swap_state(spark.createDataFrame([(n,)], "v int"), str(tmp_path / "t"), n)
    assert [r["v"] for r in tables.latest_state(spark, str(tmp_path / "t")).collect()] == [2]
    for at, status in (("a", "running"), ("b", "ok")):
        tables.record_run(spark, str(tmp_path / "runs"), run_id=1, status=status, started_at="2026-01-01T00:00:00Z", event_at=at)
    from bidloom.operators.runs import run_states

    events = spark.read.parquet(str(tmp_path / "runs"))
    assert [(r["run_id"], r["status"]) for r in run_states(events, "2026-01-01T01:00:00Z").collect()] == [(1, "ok")]
    hostile = "x' OR '1'='1"
    assert tables.run_sql(spark, "SELECT 1 AS one WHERE :v = 'x'", v=hostile).count() == 0
    files = spark.createDataFrame([(1, "p", "u"), (2, None, "u"), (3, "", "")], "id long, local_path string, url string")
    assert {tuple(r) for r in tables.document_lookup(files).collect()} == {(1, "stored", "p"), (2, "redirect", "u"), (3, "missing", None)}
    assert tables.without_paths(files).where("local_path is not null").count() == 0

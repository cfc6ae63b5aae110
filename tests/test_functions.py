"""Scalar functions and classification, by table."""

import pytest
from pyspark.sql import functions as F

from bidloom.functions import classify
from bidloom.functions import scalars as X


def one(spark, f, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(f(*[F.col(f"c{i}") for i in range(len(values))])).first()[0]


@pytest.mark.parametrize(
    ("f", "value", "expected"),
    [
        (X.dmy_iso, "Sun, 20/09/2026", "2026-09-20"), (X.dmy_iso, "31/13/2026", None), (X.dmy_iso, "29/02/2024 10:00", "2024-02-29"), (X.dmy_iso, None, None), (X.dmy_iso, "٢٠/٠٩/٢٠٢٦", "2026-09-20"),
        (X.dmy_iso_unchecked, "1/13/2026", "2026-13-01"), (X.dmy_iso_unchecked, "no", None), (X.digits_number, "SAR -1,200.50", 1200.5), (X.digits_number, "1.2.3", None), (X.digits_number, "none", None),
        (X.first_number, "about -1,250.5 [JOD]", -1250.5), (X.first_number, "٣٫٥ kg", 3.5), (X.first_number, "", None), (X.clean_text, " a  b\n", "a b"), (X.clean_text, "  ", None),
        (X.html_text, "<b>a</b><br/>b&nbsp;&amp;&quot;c", 'a b &"c'), (X.html_text, None, ""), (X.bracketed, "108/1995 [ x ]", "x"), (X.bracketed, "none", None), (X.entity_code, "[2701]  Royal", "2701"),
        (X.entity_name, "[2701]  Royal", "Royal"), (X.entity_name, "Royal", "Royal"), (X.drug_code, "08-030500-025", "08030500025"), (X.drug_code, "- ", None), (X.code_group, "4212345678901", "42"), (X.code_group, "42123", None),
        (X.tender_kind, "NPT0462/26", "NPT"), (X.tender_seq, "NPT0462/26", 462), (X.tender_year, "NPT0462/26", 2026), (X.tender_year, "NPT0462-2019", 2019), (X.tender_year, "bad", None),
        (X.compare_key, "12.0", "12"), (X.compare_key, None, ""), (X.compare_key, " x ", "x"), (X.url_key, "https://A.example/T%C3%A9/", "https://a.example/té"), (X.url_key, "a%zz/", "a%zz"), (X.url_slug, "https://a.example/t/%D8%A3/", "أ"),
        (X.url_file, "https://a.example/f/My%20List.PDF?x=1", "My List.PDF"), (X.url_file, "https://a.example", None), (X.file_extension, "a.tar.GZ", "gz"), (X.file_extension, "none", None), (X.safe_name, " NPT 1/26 ", "NPT_1_26"),
        (X.progress, '{"progress": "3/9"}', "3/9"), (X.progress, "broken", None), (X.table_cell, "a|b", "a\\|b"), (X.table_cell, "", "—"), (X.table_cell, "x" * 90, "x" * 70),
        (X.tax_included, "السعر النهائي غير شامل", 0), (X.tax_included, "السعر النهائي", 1), (X.tax_included, "x", None), (X.percent_encoded, "a b/ü", "a+b%2F%C3%BC"),
    ],
)
def test_scalar(spark, f, value, expected):
    assert one(spark, f, value) == expected


def test_two_argument_scalars(spark):
    assert one(spark, X.portal_key, "2000041", "2") == 1000200004102
    assert one(spark, X.portal_key, "7", "") == 10**12 + 700
    assert one(spark, lambda t, p: X.first_currency(t, p), "6840 JOD", "1.7 [USD]") == "JOD"
    assert one(spark, lambda t, p: X.first_currency(t, p), "6840", "1.7 [USD]") == "USD"
    assert one(spark, X.status_slugs, "Final Results, , Cancelled!") == ["final-results", "cancelled"]
    df = spark.createDataFrame([(0.0, 2.0), (6.0, 2.0), (None, 2.0), (3.0, 0.0)], "t double, q double")
    assert [r[0] for r in df.select(X.unit_cost(F.col("t"), F.col("q"))).collect()] == [None, 3.0, None, None]
    days = spark.createDataFrame([(-3,), (0,), (4,), (None,)], "d int")
    assert [r[0] for r in days.select(X.deadline_label(F.col("d"))).collect()] == ["closed 3d ago", "closes today", "4d left", None]
    assert days.select(X.days_left(F.lit("2026-09-20").cast("date"), "2026-09-01")).first()[0] == 19


@pytest.mark.parametrize(
    ("code", "text", "category", "accessory"),
    [
        ("5112345678901", "PARACETAMOL", "pharma", 0), ("4212345678901", "ORTHODONTIC WIRE", "dental", 0), ("4212345678901", "STEEL BOWL", "device", 0), ("4112345678901", "DENTAL ASSAY", "dental", 0),
        ("4112345678901", "TABLET READER", "lab", 0), (None, "INSULIN PEN", "pharma", 0), (None, "صيانة المبنى", "service", 0), ("5112345678901", "Maintenance of pumps", "service", 0), ("9912345678901", "thing", "other", 0),
        (None, None, "other", 0), ("4212345678901", "Warranty cost related to item 3", "service", 1), (None, "predental", "other", 0),
    ],
)
def test_categories(spark, code, text, category, accessory):
    assert one(spark, classify.item_category, code, text) == category
    assert one(spark, lambda c, t: classify.accessory(t), code, text) == accessory

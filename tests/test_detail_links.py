"""Links of all tenders against urllib."""

import os
from urllib.parse import urlencode

import pytest

from bidloom.plans import portal
from bidloom.session import table


def link(number, method, buyer):
    return "https://p.example/d?" + urlencode({"tendNo": number or "", "method": method or "", "buyer": buyer or ""})


def test_escapes(spark, tmp_path):
    rows = [
        (1, "7/2026", "Limited bidding, two envelopes", "B", "a", None), (2, None, None, None, "", "b"), (3, "a&b=c#d?e%f+g", "مناقصة عامة", "x;y", None, None), (4, "x\ty\nz", "\"q\" 'r' (s) <t>", "-_.", "a", "b"),
    ]
    spark.createDataFrame(rows, "post_id long, tender_id string, method string, buyer string, title_en string, title_ar string").write.parquet(str(tmp_path / "tenders.parquet"))
    got = {r["post_id"]: (r["link"], r["title"]) for r in portal.QUERIES["detail_links"](spark, str(tmp_path)).collect()}
    assert got == {i: (link(n, m, b), en or ar or None) for i, n, m, b, en, ar in rows}


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables here")
def test_no_tender_is_left_out(spark):
    d = "/root/testdata/sf0.1"
    tenders = table(spark, d, "tenders").select("post_id", "tender_id", "method", "buyer").collect()
    got = portal.QUERIES["detail_links"](spark, d).collect()
    assert sorted((r["post_id"], r["link"]) for r in got) == sorted((r["post_id"], link(r["tender_id"], r["method"], r["buyer"])) for r in tenders)

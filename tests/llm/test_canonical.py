"""Formatting duplicates."""

import os
import random
from urllib.parse import quote

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bidloom.llm import canonical
from bidloom.session import table

SCHEMA = "post_id long, tender_id string, url string, key string, id long, least long, rows long, salt int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2, 3, 4) for r in rows], SCHEMA)


def found(df):
    rows = [tuple(r) for r in df.select("kept", "copy").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def copies(df, **more):
    return canonical.formatted_copies(df, "post_id", canonical.tender_key(), **more)


def test_same_and_not_same(spark):
    base = "https://x.example/p/d.do?no=1&seq=2&cat=A"
    rows = [
        (5, "NP-1/26", base), (3, " np_1 / 26", "HTTPS://x.example/p/d.do/?SEQ=2&cat = a&no=1&#"), (9, "NP126", "https://x.example/p/d%2Edo?cat=A&seq=%32&no=1"),
        (10, "NP-1/26", "https://x.example/p/d.do?no=2&seq=1&cat=A"),  # values changed places
        (11, "NP-1/26", "https://x.example/p/d.do?no=1&seq=2&cat=A&cat=A"), (12, "NP-1/27", base), (13, None, base), (14, "NP-1/26", None), (None, "NP-1/26", base),
        (20, "أ-1", "https://x.example/" + quote("أسنان-طبية")), (21, "أ/1", "https://x.example/أسنان_طبية/"), (22, "%zz", "a%"), (23, "zz", "A"), (30, "", ""), (31, "--", "?&"),
        (40, "L", "u" * 300_000), (41, "l", "U" * 300_000),
    ]
    assert found(copies(frame(spark, rows))) == {(3, 5), (3, 9), (20, 21), (22, 23), (30, 31), (40, 41)}
    assert found(copies(frame(spark, rows).limit(0))) == set()


def test_rows_and_ties_are_kept(spark):
    """A set that holds most of all rows keeps each of them, and repeated ids are copies of nothing."""
    rows = [(i, "T1" if i % 3 else f"T{i}", "u") for i in range(3000)] + [(1, "T1", "u")]
    got = copies(frame(spark, rows))
    assert found(got) == {(1, i) for i in range(2, 3000) if i % 3}
    assert {r["copies"] for r in got.collect()} == {2001}


@pytest.mark.parametrize("fits", [1, 7, 100])
def test_recursive_buckets_count_right(spark, fits):
    random.seed(fits)
    words = ["same prefix of many keys " + "".join(random.choices("ab", k=random.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(words)), "id long, w string").select("id", F.encode("w", "UTF-8").alias("key"))
    got = {bytes(r["key"]).decode(): (r["least"], r["rows"]) for r in canonical.counted_keys(df, fits).collect()}
    assert got == {w: (words.index(w), words.count(w)) for w in words}


def test_prefixes_deepen_until_buckets_fit(spark):
    df = spark.createDataFrame([(w.encode(),) for w in ["aaaa1", "aaaa2", "aaab1", "abcd1", "b"]], "key binary")
    over = canonical.oversized_prefixes(df, 1)
    assert over[2] == [b"aa"] and over[4] == [b"aaaa"]
    buckets = df.select(canonical.radix_bucket(over)).collect()
    assert len({r[0] for r in buckets}) == 5


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=3), st.text("xyz12", max_size=3)), min_size=1, max_size=4), st.randoms())
def test_order_and_case_of_parameters_mean_nothing(spark, pairs, rnd):
    url = lambda ps: "https://a.example/p?" + "&".join(f"{k}={v}" for k, v in ps)
    mixed = [(k.upper() if rnd.random() < 0.5 else k, v) for k, v in pairs]
    rnd.shuffle(mixed)
    a, b = spark.createDataFrame([(url(pairs),), (url(mixed) + "&",)], "u string").select(canonical.canonical_url(F.col("u"))).collect()
    assert a[0] == b[0]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables here")
def test_small_buckets_change_nothing(spark):
    df = table(spark, "/root/testdata/sf0.01", "tenders")
    assert found(copies(df)) == found(copies(df, least_fit=10))

"""Mixing to token shares."""

import math
import os

import pytest

from bidloom.llm import mixing

pytestmark = pytest.mark.skipif(not os.path.exists(mixing.VOCABULARY), reason="no vocabulary here")


def frames(spark, docs, targets):
    return spark.createDataFrame([(*d, 9, 9) for d in docs], "doc_id long, source string, text string, copies int, n_tokens int"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int")


def texts(n, source, size, start):
    return [(start + i, source, "word " * (1 + (i * 7) % size)) for i in range(n)]


def test_shares_and_caps(spark):
    docs = texts(800, "big", 40, 0) + texts(60, "small", 20, 2000) + texts(300, "mid", 60, 4000) + [(9000, None, "x"), (9001, "big", None), (9002, "big", ""), (9003, "other", "y " * 50)]
    df, targets = frames(spark, docs, [("big", 0.5, 1), ("small", 0.1, 4), ("mid", 0.3, 2), ("absent", 0.1, 2)])
    corpus, goals = mixing.mixture(df, targets)
    rows = corpus.collect()
    caps = {"big": 1, "small": 4, "mid": 2}
    assert all(1 <= r["copies"] <= caps[r["source"]] for r in rows) and len({r["doc_id"] for r in rows}) == len(rows)
    report = {r["source"]: r for r in mixing.share_report(corpus, goals).collect()}
    for s, share in (("big", 0.5 / 0.9), ("small", 0.1 / 0.9), ("mid", 0.3 / 0.9)):
        assert report[s]["share"] == pytest.approx(share, abs=0.002)
    assert report["absent"]["tokens"] == 0
    # The largest corpus: some source is used as often as it may be.
    assert any(report[s]["tokens"] == pytest.approx(caps[s] * goals[s].tokens) for s in caps)


def test_given_size_and_rates(spark):
    docs = texts(500, "a", 30, 0) + texts(500, "b", 30, 1000)
    df, targets = frames(spark, docs, [("a", 0.25, 3), ("b", 0.75, 3)])
    corpus, goals = mixing.mixture(df, targets, total_tokens=8000)
    got = {r["source"]: r["tokens"] for r in mixing.share_report(corpus, goals).collect()}
    assert got["a"] == pytest.approx(2000, abs=40) and got["b"] == pytest.approx(6000, abs=40)
    assert all(math.isfinite(g.tilt) for g in goals.values())


def test_nothing_to_mix(spark):
    df, targets = frames(spark, [(1, "a", "x")], [("b", 1.0, 1)])
    corpus, goals = mixing.mixture(df, targets)
    assert corpus.count() == 0 and mixing.share_report(corpus, goals).count() == 1
    corpus, goals = mixing.mixture(df.limit(0), targets)
    assert corpus.count() == 0
    corpus, goals = mixing.mixture(df, targets.limit(0))
    assert corpus.count() == 0 and mixing.share_report(corpus, goals).count() == 0
    one, goals = mixing.mixture(*frames(spark, [(1, "a", "x y z")], [("a", 1.0, None), ("a", 1.0, 2), (None, 1.0, 1), ("z", 0.0, 1), ("y", None, 1)]))
    assert [(r["doc_id"], r["copies"]) for r in one.collect()] == [(1, 2)]


def test_tokens_are_of_whole_texts(spark):
    df, _ = frames(spark, [(1, "a", "hello world"), (2, "a", "قيمة الضمان"), (3, None, ""), (4, "a", None)], [("a", 1.0, 1)])
    got = {r["doc_id"]: r["n_tokens"] for r in mixing.token_sizes(df).collect()}
    assert got[1] == 2 and got[2] > 4 and got[3] == 0 and set(got) == {1, 2, 3}

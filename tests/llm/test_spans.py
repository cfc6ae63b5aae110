"""Shared spans."""

import random

import numpy as np
import pytest

from bidloom.llm import spans


def brute(docs, least):
    """{doc: shared characters} by all windows."""
    homes = {}
    for d, t in docs:
        for k in range(len(t or "") - least + 1):
            homes.setdefault(t[k : k + least], set()).add(d)
    marks = {}
    for d, t in docs:
        for k in range(len(t or "") - least + 1):
            if len(homes[t[k : k + least]]) > 1:
                marks.setdefault(d, set()).update(range(k, k + least))
    return {d: len(m) for d, m in marks.items()}


def frame(spark, docs):
    return spark.createDataFrame([(*d, 1, 2, "x") for d in docs], "doc_id long, text string, anchor int, place int, stretch string")


def found(spark, docs, least=240, **more):
    rows = spans.shared_characters(frame(spark, docs), least, **more).collect()
    assert len(rows) == len({r["doc_id"] for r in rows})
    return {r["doc_id"]: r["shared_chars"] for r in rows}


def corpus(seed, n=60, clause_sizes=(239, 240, 241, 300, 500)):
    rnd = random.Random(seed)
    text = lambda k: "".join(rnd.choices("abcdefghij klmé😀", k=k))
    clauses = [text(k) for k in clause_sizes]
    docs = []
    for d in range(n):
        body = text(rnd.randint(0, 400))
        for _ in range(rnd.randint(0, 2)):
            c = rnd.choice(clauses)
            a = rnd.randint(0, 30)
            cut = c[a : len(c) - rnd.randint(0, 30)] if rnd.random() < 0.5 else c
            body += cut + text(rnd.randint(0, 50))
        docs.append((d, body))
    return docs


@pytest.mark.parametrize(("seed", "fits"), [(0, spans.FITS), (1, spans.FITS), (2, 2), (3, 0), (4, 5)])
def test_equals_brute_force(spark, seed, fits):
    docs = corpus(seed)
    assert found(spark, docs, fits=fits) == brute(docs, 240)


def test_an_anchor_of_many_places(spark):
    """A clause in more documents than a shard holds, between texts of their own, with near misses of it and some texts filed twice."""
    rnd = random.Random(17)
    text = lambda k: "".join(rnd.choices("abcdefghij klm", k=k))
    clause, docs = text(260), []
    for d in range(spans.FITS + 600):
        body = clause
        if d % 50 == 0:
            at = rnd.randrange(260)
            body = body[:at] + "#" + body[at + 1 :]
        elif d % 7 == 0:
            body = body[rnd.randrange(30) :]
        elif d % 11 == 0:
            body = body[: 260 - rnd.randrange(30)]
        docs.append((d, text(rnd.randint(0, 12)) + body + text(rnd.randint(0, 12))))
    docs += [(10_000 + d, t) for d, t in docs[:40]]
    assert found(spark, docs) == brute(docs, 240)


@pytest.mark.parametrize("least", [30, 64, 150])
def test_other_lengths(spark, least):
    docs = corpus(11, 30, (29, 30, 64, 150, 151))
    assert found(spark, docs, least) == brute(docs, least)


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(spans, "SHARD", 3)
    docs = corpus(7)
    assert found(spark, docs) == brute(docs, 240)


def test_edges(spark):
    long = "".join(random.Random(5).choices("abcdefgh ", k=20_000))
    docs = [
        (1, long), (2, "x" + long), (3, long[:239]), (4, None), (5, ""), (None, long), (6, long[:300] * 2), (7, "q" * 1000), (8, "q" * 241), (9, "z" * 700),
        (10, long[5000:5240]), (11, "only here " * 60), (12, long), (12, long),
    ]
    usable = [(d, t) for d, t in docs if d is not None]
    assert found(spark, docs) == brute(usable, 240)
    assert found(spark, docs[:0] or [(1, None)]) == {}
    assert spans.shared_characters(frame(spark, docs).limit(0)).count() == 0


def test_a_stretch_repeated_in_one_document_is_not_shared(spark):
    part = "".join(random.Random(9).choices("abcdefgh", k=300))
    assert found(spark, [(1, part + "--" + part), (2, "other " * 100)]) == {}
    assert found(spark, [(1, part), (1, part)]) == {}


def test_hashes_depend_on_content_only():
    text = "".join(random.Random(1).choices("abc", k=500))
    codes = lambda t: spans._codes([t])[0]
    alone = spans.gram_hashes(codes(text[200:264]), 64)
    assert spans.gram_hashes(codes(text), 64)[200] == alone[0]
    assert spans._sliding(np.array([5, 1, 4, 2, 9, 0], np.uint64), 3, np.minimum).tolist() == [1, 1, 2, 0]


def test_every_stretch_has_its_anchor():
    rnd = random.Random(3)
    shared = "".join(rnd.choices("abcdefgh", k=240))
    for _ in range(30):
        a, b = ("".join(rnd.choices("abcdefgh", k=rnd.randint(0, 500))) for _ in range(2))
        texts = [a + shared + b, b[:17] + shared + a]
        who, place, h = spans.anchors(texts, 240)
        inside = [{int(x) for w, p, x in zip(who, place, h) if w == i and t.find(shared) <= p <= t.find(shared) + 240 - spans.anchor_length(240)} for i, t in enumerate(texts)]
        assert inside[0] & inside[1]

"""Leaked test passages."""

import itertools
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bidloom.llm import leakage

WORDS = [f"w{i}" for i in range(60)]


def frames(spark, docs, items):
    return spark.createDataFrame([(*d, "clash", 1) for d in docs], "doc_id long, text string, lang string, item_id int"), spark.createDataFrame([(*i, "en") for i in items], "item_id long, text string, lang string")


def exact(docs, items, run=13):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for d, text in docs:
        w = words(text)
        grams = {tuple(w[k : k + run]) for k in range(len(w) - run + 1)}
        for i, t in items:
            v = words(t)
            if any(tuple(v[k : k + run]) in grams for k in range(len(v) - run + 1)):
                out.add((d, i))
    return out


def found(spark, docs, items, **more):
    leaks = leakage.leaked_items(*frames(spark, docs, items), **more)
    return {(r["doc_id"], r["item_id"]) for r in leaks.collect() if r["distance"] == 0 and r["longest_run"] >= 13}


@pytest.mark.parametrize("seed", range(3))
def test_exact_runs_equal_brute_force(spark, seed):
    rnd = random.Random(seed)
    items = [(i, " ".join(rnd.choices(WORDS, k=rnd.randint(8, 30)))) for i in range(25)]
    docs = []
    for d in range(120):
        body = rnd.choices(WORDS, k=rnd.randint(0, 60))
        if d % 2:
            w = items[rnd.randrange(25)][1].split()
            k = rnd.randint(0, max(0, len(w) - 12))
            piece = w[k : k + rnd.randint(11, 20)]
            if d % 3 == 0 and piece:
                piece[rnd.randrange(len(piece))] = "near"
            at = rnd.randint(0, len(body))
            body[at:at] = [x.upper() if rnd.random() < 0.3 else x for x in piece]
        docs.append((d, rnd.choice([" ", ", ", "\n- ", "_"]).join(body)))
    assert found(spark, docs, items) == exact(docs, items)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(leakage, "BLOCK", 2)  # several blocks of items
    q = "إذا لم يراجع المظروف الرافعة قبل أن يعادل الخازن 45 المظروف بينما يلغي الحارس"
    items = [(1, q + "؟"), (2, " ".join(WORDS[:13])), (3, "too short"), (4, None), (5, " ".join(["a"] * 20)), (2, " ".join(WORDS[:13]))]
    docs = [(1, "x " + q.replace(" ", " – ")), (2, "W0-" + " ".join(WORDS[1:13])), (2, "W0-" + " ".join(WORDS[1:13])), (3, None), (4, ""), (5, "a " * 5000), (None, q), (6, " ".join(WORDS[:12]))]
    assert found(spark, docs, items) == {(1, 1), (2, 2), (5, 5)}
    assert found(spark, docs, [(3, "too short")]) == set() == found(spark, docs, [])
    df = frames(spark, docs, items)
    assert leakage.leaked_items(df[0].limit(0), df[1]).count() == 0


def test_one_changed_word_is_within_the_budget(spark):
    item = " ".join(WORDS[:20])
    docs = [(1, " ".join([*WORDS[:9], "other", *WORDS[10:20]])), (2, " ".join([*WORDS[:6], "a", "b", *WORDS[8:12], "c", *WORDS[13:20]]))]
    got = {(r["doc_id"], r["distance"]) for r in leakage.leaked_items(*frames(spark, docs, [(1, item)])).collect()}
    assert got == {(1, 1)}


@pytest.mark.parametrize("words", [13, 14, 19, 20, 27])
def test_an_edit_is_found_at_every_place(words):
    """Every window of the item, alone in a document with any one word changed, left out or put in, against the window itself."""
    item = WORDS[:words]
    passages = leakage.Passages([(1, " ".join(item))])
    for s in range(words - 12):
        for k in range(13):
            window = item[s : s + 13]
            for edited in ([*window[:k], "other", *window[k + 1 :]], [*window[:k], *window[k + 1 :]], [*window[:k], "other", *window[k:]]):
                ((leaked, run, distance),) = passages.leaks(" ".join(["x", *edited, "y"]))
                # A word put in before the first is none of the passage.
                assert (leaked, distance) == (1, 0 if len(edited) == 14 and k == 0 else 1), (s, k, edited)
                assert run >= max(k, 12 - k)


def near(own, words, run=13, budget=1):
    """Smallest edit distance, in words, of any window of own from any stretch of words, by dynamic programming; None above the budget."""
    best = budget + 1
    for s in range(len(own) - run + 1):
        row = [0] * (len(words) + 1)
        for i, x in enumerate(own[s : s + run], 1):
            new = [i]
            for j, y in enumerate(words, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        best = min(best, *row)
    return best if best <= budget else None


@pytest.mark.parametrize("seed", range(4))
def test_near_passages_equal_brute_force(spark, seed):
    """Documents with passages under several edits, of few different words, so that pieces also meet where no passage is."""
    rnd = random.Random(seed)
    words = WORDS[: (12 if seed % 2 else 60)]
    items = [(i, " ".join(rnd.choices(words, k=rnd.randint(11, 26)))) for i in range(12)]
    docs = []
    for d in range(80):
        body = rnd.choices(words, k=rnd.randint(0, 40))
        w = items[rnd.randrange(12)][1].split()
        k = rnd.randint(0, max(0, len(w) - 12))
        piece = w[k : k + rnd.randint(12, 20)]
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randrange(len(piece))
            piece[at : at + rnd.randint(0, 1)] = rnd.choice([[], ["near"], [rnd.choice(words)]])
        at = rnd.randint(0, len(body))
        body[at:at] = piece
        docs.append((d, " ".join(body)))
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in leakage.leaked_items(*frames(spark, docs, items)).collect()}
    brute = {(d, i): n for d, t in docs for i, u in items if (n := near(u.split(), t.split())) is not None}
    assert got == brute and len(brute) > 20


def test_as_many_changed_words_as_the_budget():
    item = WORDS[:31]
    for budget in (0, 2, 3):
        passages = leakage.Passages([(1, " ".join(item))], budget=budget)
        for s in range(31 - 12):
            for places in itertools.combinations(range(13), budget):
                window = ["other" if k in places else w for k, w in enumerate(item[s : s + 13])]
                assert [(i, d) for i, _, d in passages.leaks(" ".join(["x", *window, "y"]))] == [(1, budget)], (s, places)


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", max_size=70), st.text("abcd", max_size=70))
def test_myers_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    assert leakage.myers_distance(a, b) == row[-1]


@settings(max_examples=300, deadline=None)
@given(st.text("abcd", max_size=20), st.text("abcd", max_size=40))
def test_myers_distance_from_the_nearest_stretch(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    assert leakage.myers_distance(a, b, anywhere=True) == min(row)

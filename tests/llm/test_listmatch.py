"""Product texts mapped to the list."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bidloom.llm import listmatch
from bidloom.session import table

LIST = [("42001", "ZELWEXDASKEX", "12 FR", "TUBING"), ("51001", "CRICLEMNEPEX", "250 MG", "CAPSULE"), ("51002", "CRICLEMNEPEX", "1000 MG", "CAPSULE"), ("41001", "JORCRIJOREX", "120 TESTS", "TEST KIT"), ("51003", None, "5 MG", "SYRUP")]

#: Coded items of other products, from whose texts the words are learned; forms alternate, so that remarks belong to none.
TAUGHT = [("9%03d" % i, name, "5 MG", form) for i, (name, form) in enumerate([(n, f) for n in ("BOLZUK", "DWIMARG", "FULKOSH", "GRUDBIN", "HAZTOLK", "KWIBDUR") for f in ("SYRUP", "CAPSULE")])]
REMARKS = ("NEW TENDER", "LATEX FREE", "sterile", "size")
LESSONS = [(1000 * k + i, code, f"{name}, 5 MG {form} ({remark}", None) for k, remark in enumerate(REMARKS, 1) for i, (code, name, _, form) in enumerate(TAUGHT)]


@pytest.mark.parametrize(
    ("text", "generic", "code"),
    [
        ("zelwexdaskex 12 fr tubing", None, "42001"), ("TUBNG - Zelwexdaksex - SIZE 12 CH (LATEX FREE", None, "42001"), ("ZELWEX. French 12 tubings", None, "42001"), ("CRICLEM NEPEX, 0.25 G, CAPS", None, "51001"),
        ("criclem-nepex 250,000 MCG cap new tender", None, "51001"), ("Criclemnpx 1 GM. capsules", None, "51002"), ("CRICLEMNEPEX 25 ملغ CAP", None, "UNMATCHED"), ("criclemnepex 250 mg tablet", None, "UNMATCHED"),
        ("JORCRIJOREX 120 TEST KIT, TEST", None, "41001"), ("testkit jorcrijorex /120 tests", None, "41001"), ("KIT, TEST jorcri- 120T sterile", None, "41001"), ("capsule 250 mg", "Criclemnepex", "51001"),
        ("CRICLE 250 MG CAP", "CRICLEDASKUM", "UNMATCHED"), ("CRICLE 250 MG CAP", "criclemnepx", "51001"), ("CRICLEMNEXPX 250 MG CAP", "CRICLEMNOXPX", "UNMATCHED"), ("CRICLEMNEPX 250 MG CAP", "CRICLEMQUAZOX", "51001"), ("WEXOLPRATUN 250 MG CAP", None, "UNMATCHED"), ("", None, "UNMATCHED"), (None, None, "UNMATCHED"), ("x " * 50_000, None, "UNMATCHED"),
        ("CRICLEMNEPEX CAPSULE", None, "UNMATCHED"), ("ZEL 12 FR TUBING", None, "UNMATCHED"), ("ZELWEXDASKEX ١٢ FR TUBING", None, "42001"),
    ],
)
def test_match(spark, text, generic, code):
    items = spark.createDataFrame([(*r, "clash") for r in [(1, None, text, generic), *LESSONS]], "id long, nupco_code string, description string, generic_name string, list_code string")
    products = spark.createDataFrame(LIST + TAUGHT, "list_code string, generic_name string, strength string, dosage_form string")
    assert [tuple(r) for r in listmatch.match_products(items, products).collect()] == [(1, code)]


def test_a_new_form_of_the_list_is_known(spark):
    """By its name, plural and clear abbreviations at once; by other spellings as soon as coded items use them."""
    products = spark.createDataFrame([*LIST, *TAUGHT, ("6000", "BOLZUK", "5 MG", "LOZENGE")] + [(f"6{i:03d}", n, "5 MG", "LOZENGE") for i, (_, n, _, f) in enumerate(TAUGHT, 1) if f == "SYRUP" and n != "BOLZUK"], "list_code string, generic_name string, strength string, dosage_form string")
    texts = ["BOLZUK 5 MG lozenge", "Lozenges BOLZUK 5 MG", "BOLZUK 5 MG LOZ", "BOLZUK LZNG 5 MG", "BOLZUK 5 MG PASTILLE"]
    rows = [(i, None, t, None) for i, t in enumerate(texts)]
    schema = "id long, nupco_code string, description string, generic_name string"
    found = lambda rows: [r["list_code"] for r in listmatch.match_products(spark.createDataFrame(rows, schema), products).orderBy("item_id").collect()]
    assert found(rows) == ["6000"] * 4 + ["UNMATCHED"]
    lessons = [(100 + i, f"6{i:03d}", f"{n} 5 MG PASTILLE", None) for i, (_, n, _, f) in enumerate(TAUGHT, 1) if f == "SYRUP" and n != "BOLZUK"] + [(100, "6000", "PASTILLE 5 MG BOLZUK", None)]
    assert found(rows + lessons) == ["6000"] * 5


def test_words_are_learned(spark):
    schema = "id long, nupco_code string, description string, generic_name string"
    taught = spark.createDataFrame([(c, n, f) for c, n, _, f in TAUGHT], "nupco_code string, name string, form string")
    rows = LESSONS + [(1, "9000", "BOLZUK 5 MG SYRUP ODD", None), (2, None, "NEW WORDS", None), (3, "9001", None, None)]
    spellings, noise = listmatch.learned_words(spark.createDataFrame(rows, schema), taught)
    assert spellings == {"SYRUP": "SYRUP", "CAPSULE": "CAPSULE"} and noise == {"NEW", "TENDER", "LATEX", "FREE", "STERILE", "SIZE"}
    with pytest.raises(ValueError):
        listmatch.learned_words(spark.createDataFrame(rows, schema), taught, most_words=2)


def test_sizes_at_the_very_threshold():
    assert [n for _, n in listmatch.NameIndex(["AABADA"], 0.2).similar("BEAACBABBCCA")] == ["AABADA"]


def test_only_items_without_a_listed_code(spark):
    items = spark.createDataFrame([(1, "42001", "x", None), (2, "4200", "x", None), (3, None, "x", None), (3, None, "x", None), (None, None, "x", None)], "id long, nupco_code string, description string, generic_name string")
    products = spark.createDataFrame(LIST, "list_code string, generic_name string, strength string, dosage_form string")
    assert {r["item_id"] for r in listmatch.match_products(items, products).collect()} == {2, 3}
    assert listmatch.match_products(items, products).count() == 2 and listmatch.match_products(items.limit(0), products).count() == 0
    assert {r["list_code"] for r in listmatch.match_products(items, products.limit(0)).collect()} == {"UNMATCHED"}
    with pytest.raises(ValueError):
        listmatch.match_products(items, products, most_products=2)


letters = st.text("ABCDELMNORSTUX", min_size=3, max_size=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(letters, min_size=1, max_size=30, unique=True), letters, st.sampled_from([0.2, 0.25, 0.4, 0.6, 0.8]))
def test_the_join_loses_nothing(names, word, threshold):
    """Prefix, length and positional filters give what comparing with every name gives."""
    index = listmatch.NameIndex(names, threshold)
    own = set(listmatch.grams(word))
    brute = {n for n in names if len(own & (g := set(listmatch.grams(n)))) / len(own | g) >= threshold}
    assert {n for _, n in index.similar(word)} == brute


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_edits(a, b):
    from functools import cache

    @cache
    def d(i, j):
        if not i or not j:
            return i + j
        best = min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            best = min(best, d(i - 2, j - 2) + 1)
        return best

    assert listmatch.edits(a, b, 2) == min(3, d(len(a), len(b))) and listmatch.edits(a, b, 9) == d(len(a), len(b))


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables here")
def test_accuracy_on_items_with_a_code(spark):
    """Held-out truth: one half of the items with a listed code teaches the words, the other is matched by its text alone."""
    d = "/root/testdata/sf0.01"
    products = table(spark, d, "product_list")
    coded = table(spark, d, "tender_items").join(products.select(F.col("list_code").alias("nupco_code")), "nupco_code").dropDuplicates(["id"])
    taught = F.when(F.xxhash64("id") % 2 == 0, F.col("nupco_code"))
    found = listmatch.match_products(coded.select("id", taught.alias("nupco_code"), "description", "generic_name"), products)
    right = coded.join(found, F.col("id") == F.col("item_id")).select((F.col("list_code") == F.col("nupco_code")).alias("ok")).collect()
    assert len(right) > 2000 and sum(r["ok"] for r in right) / len(right) > 0.999


def test_typos_find_their_name():
    random.seed(4)
    syllables = "zel wex dask cri clem nep jor tun hab vor".split()
    names = ["".join(random.sample(syllables, 3)).upper() + random.choice(["EX", "IUM", "ATE"]) for _ in range(60)]
    index = listmatch.NameIndex(names)
    lost = 0
    for name in names:
        for _ in range(20):
            word = list(name)
            for _ in range(2):
                i = random.randrange(len(word) - 1)
                kind = random.randrange(4)
                if kind == 0:
                    word[i], word[i + 1] = word[i + 1], word[i]
                elif kind == 1:
                    del word[i]
                elif kind == 2:
                    word.insert(i, random.choice("ABCXYZ"))
                else:
                    word[i] = random.choice("ABCXYZ")
            got = index.name_of("".join(word))
            lost += got is None or listmatch.edits("".join(word), got, 2) > listmatch.edits("".join(word), name, 2)
    assert lost <= 12  # of 1200

"""Freely typed product texts mapped to a canonical list by a prefix-filter set-similarity join."""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.functions.digits import ascii_digits

UNMATCHED = "UNMATCHED"

#: Strength unit -> (common unit, factor over, factor under).
STRENGTH_UNITS = {
    "MCG": ("MG", 1, 1000), "UG": ("MG", 1, 1000), "MG": ("MG", 1, 1), "ملغ": ("MG", 1, 1), "GM": ("MG", 1000, 1), "G": ("MG", 1000, 1), "غم": ("MG", 1000, 1),
    "FRENCH": ("FR", 1, 1), "FR": ("FR", 1, 1), "CH": ("FR", 1, 1), "TESTS": ("TESTS", 1, 1), "TEST": ("TESTS", 1, 1), "T": ("TESTS", 1, 1),
}

_DIGITS = str.maketrans("٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "0123456789" * 2)
_UNITS = "|".join(sorted(STRENGTH_UNITS, key=len, reverse=True))
_STRENGTH = re.compile(r"(?<![^\W_])([0-9]+(?:[.,][0-9]+)*)[\s-]*(" + _UNITS + r")(?![^\W_])|(?<![^\W_])(FRENCH|FR|CH)[\s-]*([0-9]+)(?![^\W_])")
_WORDS = re.compile(r"[^\W\d_]+")


def strength_of(number: str, unit: str) -> tuple[str, float] | None:
    """A strength in its common unit. A comma before exactly three digits groups thousands, else it is the decimal sign."""
    plain = re.sub(r",(?=[0-9]{3}(?![0-9]))", "", number).replace(",", ".")
    try:
        value = float(plain)
    except ValueError:
        return None
    common, over, under = STRENGTH_UNITS[unit]
    return common, round(value * over / under, 6)


def skeleton(word: str) -> str:
    """A word without the vowels behind its first letter."""
    return word[:1] + re.sub("[AEIOU]", "", word[1:])


def lacks_letters(word: str, name: str) -> bool:
    """Whether word is name without some letters behind the first."""
    rest = iter(name)
    return word[:1] == name[:1] and all(letter in rest for letter in word)


def stem(word: str, name: str) -> str:
    """The letters with which both begin."""
    return os.path.commonprefix([word, name])


@dataclass
class Vocabulary:
    """What words of product texts mean beside the substance: spellings of dosage forms, and words that say nothing about the product."""

    forms: tuple[str, ...]
    spellings: dict[str, str] = field(default_factory=dict)
    noise: frozenset[str] = frozenset()
    names: tuple[str, ...] = ()

    def __post_init__(self):
        known: dict[str, str] = {}
        for form in sorted(self.forms):
            words = _WORDS.findall(form)
            for word in ("".join(words), words[-1] if words else ""):
                if word:
                    known.setdefault(word, form)
                    known.setdefault(word + "S", form)
        # Words of a form of several words that don't name it alone.
        self.parts = {w for form in self.forms for w in _WORDS.findall(form)} - set(known)
        self.known = known | self.spellings

    def short_form(self, word: str) -> str | None:
        """The only form that a word of three letters or more abbreviates or inflects, by the first rule that any form's name meets: it
        becomes the word without vowels; it begins with it; it becomes it without other letters; both share a stem of four letters, half of
        the longer. What a substance begins or ends with is none."""
        word = word.removesuffix("S") if len(word) > 3 else word
        if len(word) < 3 or any(name.startswith(word) or name.endswith(word) for name in self.names):
            return None
        rules = (
            lambda name: skeleton(word) == skeleton(name) and lacks_letters(word, name),
            lambda name: name.startswith(word),
            lambda name: lacks_letters(word, name),
            lambda name: len(stem(word, name)) >= max(4, max(len(word), len(name)) / 2),
        )
        for rule in rules:
            if fits := {form for name, form in self.known.items() if rule(name)}:
                return fits.pop() if len(fits) == 1 else None
        return None

    def parse(self, text: str) -> tuple[str, tuple[str, float] | None, str | None]:
        """(substance letters, strength, dosage form) of a product text.

        The strength, the words of forms and those without meaning are taken out; the letters that remain, joined, are the substance. If no
        known spelling names the form, a word that can only be one form's abbreviation does. An empty substance, no strength or no form is
        what the text lacks.
        """
        up = text.upper().translate(_DIGITS)
        strength, form, letters = None, None, []
        if m := _STRENGTH.search(up):
            strength = strength_of(m[1] or m[4], m[2] or m[3])
            up = up[: m.start()] + " " + up[m.end() :]
        for word in _WORDS.findall(up):
            if word in self.known:
                form = form or self.known[word]
            elif word not in self.noise and word not in self.parts:
                letters.append(word)
        if form is None:
            for k, word in enumerate(letters):
                if form := self.short_form(word):
                    del letters[k]
                    break
        return "".join(letters), strength, form


def learned_words(items: DataFrame, products: DataFrame, least_names: int = 6, sure: float = 0.95, most_words: int = 100_000) -> tuple[dict[str, str], frozenset[str]]:
    """(spellings of forms, words without meaning), from the texts of all items whose code is in the list.

    A word that stands beside `least_names` substances or more, none of which it is a part of, belongs to no substance. If `sure` of its rows are of
    one dosage form it spells that form, else it means nothing. Units of strength are left out. products: (nupco_code, name, form) with the letters of
    the substance. All coded rows count; they combine on the map side by (word, name, form). The words that come back are those of the
    vocabulary, not of the data; more than most_words raise an error.
    """
    up = F.upper(ascii_digits(F.col("description")))
    rows = items.where(F.col("description").isNotNull()).select("nupco_code", F.array_distinct(F.regexp_extract_all(up, F.lit(r"\p{L}+"), F.lit(0))).alias("words"))
    words = rows.join(F.broadcast(products), "nupco_code").select("name", "form", F.explode("words").alias("word"))
    foreign = words.where(~F.col("name").contains(F.col("word")) & ~F.col("word").isin(list(STRENGTH_UNITS)))
    by_name = foreign.groupBy("word", "name", "form").agg(F.count(F.lit(1)).alias("n"))
    by_form = by_name.groupBy("word", "form").agg(F.sum("n").alias("n"), F.collect_set("name").alias("names"))
    seen = by_form.groupBy("word").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "form")).alias("top"), F.size(F.array_distinct(F.flatten(F.collect_list("names")))).alias("names"),
    )
    found = seen.where(F.col("names") >= least_names).select("word", (F.col("top.n") >= F.col("n") * sure).alias("sure"), "top.form").limit(most_words + 1).collect()
    if len(found) > most_words:
        raise ValueError(f"the vocabulary has more than {most_words} words")
    return {r["word"]: r["form"] for r in found if r["sure"]}, frozenset(r["word"] for r in found if not r["sure"])


def grams(word: str) -> list[str]:
    """The distinct pairs of neighbouring letters, with a mark before the first."""
    w = "^" + word
    return list(dict.fromkeys(w[i : i + 2] for i in range(len(w) - 1)))


def edits(a: str, b: str, most: int) -> int:
    """Letters inserted, deleted, replaced or swapped with a neighbour to turn a into b (optimal string alignment); most + 1 if more than `most`."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            v = min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, before[j - 2] + 1)
            new.append(v)
        if min(new) > most:
            return most + 1
        before, row = row, new
    return min(row[-1], most + 1)


class NameIndex:
    """A prefix-filter index over canonical names.

    Grams are ordered by rarity over all names. Two sets with Jaccard similarity t or more share a gram within the first
    n - ceil(t n) + 1 of each, so only those rare prefixes are indexed and probed; the length filter (t n <= m <= n / t) and the positional
    filter (what can still be shared behind a hit) drop candidates before the similarity is computed exactly.
    """

    def __init__(self, names: list[str], threshold: float = 0.25, most_edits: int = 2, shortest: int = 5):
        self.names, self.most, self.shortest = sorted(set(names)), most_edits, shortest
        # The threshold as a ratio of integers: sizes at the very threshold must not fall to rounding.
        self.over, self.under = Fraction(str(threshold)).as_integer_ratio()
        count = Counter(g for n in self.names for g in grams(n))
        self.rank = {g: (c, g) for g, c in count.items()}
        self.bit = {g: 1 << i for i, g in enumerate(sorted(count))}
        self.masks, self.sizes, self.posting = [], [], defaultdict(list)
        for k, name in enumerate(self.names):
            own = self._ordered(name)
            self.masks.append(sum(self.bit[g] for g in own))
            self.sizes.append(len(own))
            for pos, g in enumerate(own[: self._prefix(len(own))]):
                self.posting[g].append((k, pos, len(own)))
        self.memo: dict[str, str | None] = {}

    def _ordered(self, word: str) -> list[str]:
        return sorted(grams(word), key=lambda g: self.rank.get(g, (0, g)))

    def _prefix(self, size: int) -> int:
        return size + self.over * -size // self.under + 1

    def similar(self, word: str) -> list[tuple[float, str]]:
        """(Jaccard similarity, name) of all names at or above the threshold, best first; ties by name."""
        own = self._ordered(word)
        n = len(own)
        if not n:
            return []
        shared: dict[int, int] = {}
        for pos, g in enumerate(own[: self._prefix(n)]):
            for k, at, m in self.posting.get(g, ()):
                if self.over * n <= self.under * m and self.over * m <= self.under * n:
                    need = -(self.over * -(n + m) // (self.over + self.under))
                    so_far = shared.get(k, 0)
                    if so_far >= 0:
                        shared[k] = so_far + 1 if so_far + 1 + min(n - pos - 1, m - at - 1) >= need else -1
        mask = sum(self.bit.get(g, 0) for g in own)
        found = []
        for k, s in shared.items():
            if s > 0:
                both = (mask & self.masks[k]).bit_count()
                every = n + self.sizes[k] - both
                if both * self.under >= self.over * every:
                    found.append((-both / every, self.names[k]))
        return [(-s, name) for s, name in sorted(found)]

    def name_of(self, word: str) -> str | None:
        """The name that word stands for: the most similar of those within most_edits, of equal ones that with the fewest, else the only one it shortens."""
        if word not in self.memo:
            if len(self.memo) > 200_000:
                self.memo.clear()
            close = self.similar(word)
            best = min(((-s, e, name) for s, name in close if (e := edits(word, name, self.most)) <= self.most), default=None)
            short = [name for _, name in close if len(word) >= self.shortest and name.startswith(word)]
            self.memo[word] = best[2] if best else short[0] if len(short) == 1 else None
        return self.memo[word]


def match_products(items: DataFrame, products: DataFrame, id_column: str = "id", most_products: int = 100_000) -> DataFrame:
    """(item_id, list_code): one row per item id without a usable code, with the list entry of its text or UNMATCHED.

    The list is a fixed table; it is read whole, checked against most_products, and its index goes to the tasks, so no item is shuffled
    until the results. Forms are those of the list; how texts spell them and which words mean nothing is learned from the items with a
    listed code (learned_words), without which only the forms' own names and clear abbreviations are known. An entry must have the substance, the strength and the form. The
    substance is read from the description; where a generic name is given as well and stands for a list name, that
    settles a description that doesn't; where it stands for another or none, a merely shortened description is not trusted, and a
    typed one only if it isn't closer to the generic name. Null and
    empty texts give UNMATCHED, as does an empty list. Texts are read whole. Rows with a null id and empty tables give nothing. Redelivered rows count once; should rows of one id differ, a match goes before UNMATCHED,
    then the smaller code. Of list entries with equal substance, strength and form the smallest code stands.
    """
    listed = products.select("list_code", "generic_name", "strength", "dosage_form").limit(most_products + 1).collect()
    if len(listed) > most_products:
        raise ValueError(f"the list has more than {most_products} entries")
    entries: dict[tuple, str] = {}
    taught: dict[str, tuple[str, str, str]] = {}
    for code, generic, stated, form in sorted(tuple(r) for r in listed if None not in tuple(r)):
        number, _, unit = stated.upper().partition(" ")
        name = "".join(_WORDS.findall(generic.upper()))
        taught[code] = (code, name, form.upper())
        strength = strength_of(number, unit) if unit in STRENGTH_UNITS else None
        if strength is not None:
            entries.setdefault((name, strength, form.upper()), code)
    names = [k[0] for k in entries]
    codes = sorted({r["list_code"] for r in listed if r["list_code"] is not None})
    spark = items.sparkSession
    usable = spark.createDataFrame([(c,) for c in codes], "nupco_code string")
    spellings, noise = learned_words(items, spark.createDataFrame(list(taught.values()), "nupco_code string, name string, form string"))
    words = Vocabulary(tuple({k[2] for k in entries}), spellings, noise, tuple(names))
    open_items = (
        items.select(id_column, "nupco_code", "description", "generic_name").where(F.col(id_column).isNotNull())
        .join(F.broadcast(usable), "nupco_code", "left_anti").select(F.col(id_column).cast("long").alias("item_id"), "description", "generic_name")
    )

    def code_of(index: NameIndex, description: str | None, generic: str | None) -> str:
        letters, strength, form = words.parse(description or "")
        stated = "".join(_WORDS.findall((generic or "").upper()))
        by_text = index.name_of(letters) if letters else None
        by_generic = index.name_of(stated) if stated else None
        if by_text is None:
            name = by_generic if not letters or (by_generic and by_generic.startswith(letters)) else None
        elif stated and by_generic != by_text:
            # Two names are in question: a shortened text yields, a typed one stands unless the generic name is closer to it.
            off = edits(letters, by_text, index.most)
            if off > index.most:
                name = None
            else:
                name = by_generic if edits(letters, stated, index.most) < off else by_text
        else:
            name = by_text
        return entries.get((name, strength, form), UNMATCHED) if name else UNMATCHED

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = NameIndex(names)
        for pdf in batches:
            out = [code_of(index, d, g) for d, g in zip(pdf["description"], pdf["generic_name"])]
            yield pd.DataFrame({"item_id": pdf["item_id"], "list_code": out})

    return open_items.mapInPandas(match, "item_id long, list_code string").groupBy("item_id").agg(F.min("list_code").alias("list_code"))

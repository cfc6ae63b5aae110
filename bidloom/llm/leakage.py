"""Held-out test passages in a corpus: pigeonhole pieces, exact piece hits, Myers verification."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word is a maximal run of letters or digits.
_GAP = re.compile(r"[\W_]+")

#: Test items whose automaton one pass over the corpus carries.
BLOCK = 20_000


def words_of(text: str) -> list[str]:
    """The words of a text, letter case ignored."""
    return [w for w in _GAP.split(text.lower()) if w]


def myers_distance(pattern: str, text: str, anywhere: bool = False) -> int:
    """Edit distance of two strings by the bit-parallel algorithm of Myers; with `anywhere` that of pattern from the nearest stretch of text."""
    m = len(pattern)
    if not m:
        return 0 if anywhere else len(text)
    peq: dict[str, int] = defaultdict(int)
    for i, ch in enumerate(pattern):
        peq[ch] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = m
    # The row above the first: it grows along the text for whole strings, and is 0 throughout where a match may begin anywhere.
    carry = 0 if anywhere else 1
    for ch in text:
        eq = peq.get(ch, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (~(xh | pv) & full), pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        best = min(best, score)
        ph, mh = ((ph << 1) | carry) & full, (mh << 1) & full
        pv, mv = mh | (~(xv | ph) & full), ph & xv
    return best if anywhere else score


class Passages:
    """The windows of `run` words of each test item, cut into pieces of which each holds budget + 1, with one automaton for all pieces.

    If a stretch of a document differs from a window by at most `budget` words changed, put in or left out, one of budget + 1 disjoint pieces of
    the window stands in it unchanged. Windows of one item share their pieces, the aligned blocks of w words. A window may begin between two blocks
    and then loses up to w - 1 words before the first whole one, so w is (run + 1) // (budget + 2): (run - (w - 1)) // w >= budget + 1.
    """

    def __init__(self, items: list[tuple[int, str]], run: int = 13, budget: int = 1):
        self.run, self.budget = run, budget
        self.size = (run + 1) // (budget + 2)
        self.items = {i: words_of(t) for i, t in items}
        homes: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, words in self.items.items():
            if len(words) >= run:
                for at in range(0, len(words) - self.size + 1, self.size):
                    homes[" " + " ".join(words[at : at + self.size]) + " "].append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in homes.items():
            self.automaton.add_word(piece, (len(piece), where))
        if homes:
            self.automaton.make_automaton()
        self.empty = not homes

    def leaks(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(item, run, distance) for each item of which a passage stands in text: its longest run of equal words, and the smallest Myers
        distance of one of its windows from the words at its place, if that is within the budget."""
        flat = " " + _GAP.sub(" ", text.lower()).strip() + " "
        hits = [(end - length + 1, where) for end, (length, where) in self.automaton.iter(flat)]
        if not hits:
            return
        words = flat.split()
        # The number of the word that begins behind the blank at a place.
        number = {}
        place = 0
        for k, w in enumerate(words):
            number[place] = k
            place += len(w) + 1
        seen: dict[int, tuple[int, int]] = {}
        done = set()
        for start, where in hits:
            at = number[start]
            for item, piece_at in where:
                shift = at - piece_at
                if (item, shift, piece_at) in done:
                    continue
                own = self.items[item]
                # The run of equal words around the hit, at this alignment.
                lo, hi = piece_at, piece_at + self.size
                while lo > 0 and lo + shift > 0 and own[lo - 1] == words[lo - 1 + shift]:
                    lo -= 1
                while hi < len(own) and hi + shift < len(words) and own[hi] == words[hi + shift]:
                    hi += 1
                done |= {(item, shift, p) for p in range(lo, hi)}
                distance = self._nearest(own, words, piece_at, shift)
                if distance <= self.budget:
                    run, best = seen.get(item, (0, distance))
                    seen[item] = (max(run, hi - lo), min(best, distance))
        yield from ((i, r, d) for i, (r, d) in seen.items())

    def _nearest(self, own: list[str], words: list[str], piece_at: int, shift: int) -> int:
        """The smallest Myers distance, in words, of a window that holds the piece from any stretch of the document around its place.

        Words put in or left out before or behind the piece move the ends of the stretch by `budget` at most, so those words are looked at as well.
        """
        best = self.budget + 1
        first, last = max(0, piece_at + self.size - self.run), min(piece_at, len(own) - self.run)
        codes: dict[str, str] = {}
        code = lambda some: "".join(codes.setdefault(w, chr(0x100 + len(codes))) for w in some)
        begin = max(0, first + shift - self.budget)
        there = code(words[begin : last + self.run + shift + self.budget])
        for s in range(first, last + 1):
            lo = max(0, s + shift - self.budget - begin)
            best = min(best, myers_distance(code(own[s : s + self.run]), there[lo : s + self.run + shift + self.budget - begin], anywhere=True))
            if best == 0:
                break
        return best


def leaked_items(documents: DataFrame, items: DataFrame, run: int = 13, budget: int = 1) -> DataFrame:
    """(doc_id, item_id, longest_run, distance): documents that hold a passage of at least `run` words of a test item, up to `budget`
    words changed, put in or left out, with the longest run of equal words and the smallest distance found.

    The test items are a stated query set: they are read in blocks of 20,000 and each block's automaton passes over the whole corpus
    once; documents are never shuffled before the hits. Null and empty texts leak nothing, items of fewer than `run`
    words aren't searched. Copies of a document give one row each; a document listed twice under one id gives one row per item. Texts are
    read whole; empty tables give nothing; columns of other names change nothing.
    """
    listed = items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text")
    texts = documents.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, longest_run int, distance int"

    def searcher(block: list[tuple[int, str]]):
        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            passages = Passages(block, run, budget)
            for pdf in batches:
                found = [] if passages.empty else [(d, *leak) for d, t in zip(pdf["doc_id"], pdf["text"]) for leak in passages.leaks(t)]
                yield pd.DataFrame(found, columns=["doc_id", "item_id", "longest_run", "distance"])

        return search

    found, block = None, []
    own = (tuple(r) for r in listed.toLocalIterator())
    for row in own:
        block.append(row)
        if len(block) == BLOCK:
            part = texts.mapInPandas(searcher(block), schema)
            found, block = part if found is None else found.unionByName(part), []
    if block or found is None:
        part = texts.mapInPandas(searcher(block), schema)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(F.max("longest_run").alias("longest_run"), F.min("distance").alias("distance"))

"""Long exact spans shared between documents: confirmed passages in sharded automata."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.session import cut
from bidloom.skew import skew_safe_lookup

#: Characters of an anchor. Shorter ones recur by chance in formulaic texts, the more the larger the corpus; longer ones are more.
ANCHOR = 112

#: Characters hashed at once.
BLOCK = 1_000_000

#: Occurrences that one automaton serves, about.
SHARD = 4_000

#: Places that one key may hold in a shard; keys with more are split by further characters.
FITS = 5_000

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_tables: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse, modulo 2^64."""
    if not _tables or len(_tables["up"]) <= n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            factors = np.full(max(n, BLOCK) + 1, base, np.uint64)
            factors[0] = 1
            _tables[name] = np.multiply.accumulate(factors)
    return _tables["up"], _tables["down"]


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in one array, and the bounds of the texts in it."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return codes, np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])


def gram_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every k neighbouring code points; equal content has equal hashes wherever it stands."""
    n = len(codes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _powers(n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((codes + np.uint64(0x51ED)) * up[:n], dtype=np.uint64)])
    g = (sums[k:] - sums[:-k]) * down[: n - k + 1]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    return g ^ (g >> np.uint64(29))


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """best over every `width` neighbours, by doubling."""
    size, out = 1, values
    while 2 * size <= width:
        out = best(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return best(out[: len(out) - rest], out[rest:]) if rest else out


def anchor_length(least: int) -> int:
    """Characters of the anchors of spans of `least` characters: at most half of them."""
    return max(1, min(ANCHOR, least // 2))


def anchors(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of the anchors of all texts: in every stretch of `least` characters the gram with the smallest hash.

    The choice depends on nothing but the stretch, so equal stretches of two texts have an equal anchor at the same place in them.
    """
    codes, bounds = _codes(texts)
    g = gram_hashes(codes, anchor_length(least))
    width = least - anchor_length(least) + 1
    if len(g) < width:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    low = _sliding(g, width, np.minimum)
    starts = np.arange(len(low))
    owner = np.searchsorted(bounds, starts, "right") - 1
    low[starts + least > bounds[owner + 1]] = 0  # stretches over two texts choose nothing
    high = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), low, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    at = np.flatnonzero(high == g)
    who = np.searchsorted(bounds, at, "right") - 1
    return who, at - bounds[who], g[at].view(np.int64)


def _blocks(ids, texts, least: int) -> Iterator[tuple[list[int], list[str]]]:
    """Texts of at least `least` characters in blocks of about BLOCK characters."""
    own_ids, own, size = [], [], 0
    for i, t in zip(ids, texts):
        if len(t) >= least:
            own_ids.append(i)
            own.append(t)
            size += len(t)
            if size >= BLOCK:
                yield own_ids, own
                own_ids, own, size = [], [], 0
    if own:
        yield own_ids, own


def anchor_rows(documents: DataFrame, least: int) -> DataFrame:
    """(anchor, doc_id, place): the anchors of every document."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for ids, texts in _blocks(pdf["doc_id"], pdf["text"], least):
                who, place, h = anchors(texts, least)
                yield pd.DataFrame({"anchor": h, "doc_id": np.asarray(ids, np.int64)[who], "place": place.astype(np.int32)})

    return documents.mapInPandas(find, "anchor long, doc_id long, place int")


def stretch_rows(documents: DataFrame, places: DataFrame, least: int) -> DataFrame:
    """(key, hot, doc_id, firsts, at, stretch): the text around every given place that spans over its anchor can reach, with the place of the
    anchor in it.

    places has (doc_id, places: array of (anchor, place, hot)); anchors become keys.
    """
    reach = least - anchor_length(least)

    def carve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text, own in zip(pdf["doc_id"], pdf["text"], pdf["places"]):
                for p in own:
                    first = max(0, p["place"] - reach)
                    rows.append((p["anchor"], p["hot"], doc, [first], p["place"] - first, text[first : p["place"] + least]))
            yield pd.DataFrame(rows, columns=["key", "hot", "doc_id", "firsts", "at", "stretch"])

    return documents.join(places, "doc_id").mapInPandas(carve, "key long, hot boolean, doc_id long, firsts array<int>, at int, stretch string")


def _windows(texts: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, place, hash) of every window of `least` characters that lies in one text."""
    codes, bounds = _codes(texts)
    g = gram_hashes(codes, least)
    starts = np.arange(len(g))
    who = np.searchsorted(bounds, starts, "right") - 1
    whole = starts + least <= bounds[who + 1]
    return who[whole], (starts - bounds[who])[whole], g[whole]


def recurring_passages(docs: np.ndarray, texts: list[str], least: int) -> set[str]:
    """Passages of `least` characters that stand in texts of two documents: the first and last of each run of such windows.

    A run is shorter than `least`, since all windows of a text hold its anchor; so the two passages together cover it.
    """
    who, place, g = _windows(texts, least)
    if not len(g):
        return set()
    order = np.argsort(g, kind="stable")
    begin = np.flatnonzero(np.concatenate([[True], g[order][1:] != g[order][:-1]]))
    owners = docs[who[order]]
    twice = np.minimum.reduceat(owners, begin) != np.maximum.reduceat(owners, begin)
    shared = np.zeros(len(g), bool)
    shared[order] = np.repeat(twice, np.diff(np.concatenate([begin, [len(g)]])))
    at = np.flatnonzero(shared)
    if not len(at):
        return set()
    next_to = (who[at][1:] == who[at][:-1]) & (place[at][1:] == place[at][:-1] + 1)
    ends = at[np.concatenate([[True], ~next_to]) | np.concatenate([~next_to, [True]])]
    return {texts[w][p : p + least] for w, p in zip(who[ends], place[ends])}


def locate(docs: np.ndarray, firsts: list, texts: list[str], passages: set[str], least: int) -> list[tuple[int, int, int]]:
    """(document, from, to) of every occurrence, in any text, of a passage that stands in two documents. A text stands at all its firsts."""
    if not passages:
        return []
    automaton = ahocorasick.Automaton()
    for k, p in enumerate(passages):
        automaton.add_word(p, k)
    automaton.make_automaton()
    places, homes = [], defaultdict(set)
    for doc, own, text in zip(docs.tolist(), firsts, texts):
        for end, k in automaton.iter(text):
            places.extend((doc, first + end + 1 - least, k) for first in own)
            homes[k].add(doc)
    return [(doc, lo, lo + least) for doc, lo, k in places if len(homes[k]) > 1]


def shard_spans(stretches: DataFrame, least: int) -> DataFrame:
    """(doc_id, lo, hi): shared spans among the stretches of each key. Shards are runs of whole keys with about SHARD stretches;
    each confirms its recurring passages, compiles them into an automaton and sends the shard's texts through it."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: list[tuple] = []

        def flush() -> pd.DataFrame:
            docs = np.fromiter((r[1] for r in kept), np.int64, len(kept))
            texts = [r[3] for r in kept]
            spans = locate(docs, [r[2] for r in kept], texts, recurring_passages(docs, texts, least), least)
            kept.clear()
            return pd.DataFrame(spans, columns=["doc_id", "lo", "hi"]).drop_duplicates()

        for pdf in batches:
            for row in zip(pdf["key"], pdf["doc_id"], pdf["firsts"], pdf["stretch"]):
                if len(kept) >= SHARD and row[0] != kept[-1][0]:
                    yield flush()
                kept.append(row)
        if kept:
            yield flush()

    sharded = stretches.select("key", "doc_id", "firsts", "stretch").repartition("key").sortWithinPartitions("key")
    return sharded.mapInPandas(search, "doc_id long, lo int, hi int")


def collapsed(stretches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans, standing): the spans of documents whose stretch under a key is also another document's, and the rows that stand for each stretch.

    Documents with equal stretches share them whole. Two of them are enough to confirm what others share with them, so a stretch that any number
    of documents have goes on as two rows without places; a stretch of one document goes on with all its places.
    """
    key = ["key", "lo", "hi", "at", "stretch"]
    own = stretches.groupBy(*key, "doc_id").agg(F.array_distinct(F.flatten(F.collect_set("firsts"))).alias("firsts"))
    classes = cut(own.groupBy(*key).agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n"), F.min_by("firsts", "doc_id").alias("alone")))
    twin = F.col("a") != F.col("b")
    several = classes.where(twin).select("key", "at", "stretch", "n")
    places = skew_safe_lookup(own, several, ["key", "at", "stretch"], "doc_id", "n").select("doc_id", F.explode("firsts").alias("lo"), F.length("stretch").alias("size"))
    standing = classes.select(
        *key, F.explode(F.array_distinct(F.array("a", "b"))).alias("doc_id"), F.when(~twin, F.col("alone")).otherwise(F.array().cast("array<int>")).alias("firsts"),
    )
    return places.select("doc_id", "lo", (F.col("lo") + F.col("size")).alias("hi")), standing


def halves(standing: DataFrame, least: int) -> DataFrame:
    """The stretches of keys under longer keys, for the lower and the upper half of lo..hi.

    A window over an anchor takes i characters before it, lo <= i <= hi, and the rest of its `least` characters behind. Those with i in one half
    all hold the characters next to the anchor up to the half's least reach on either side: these make the key. So two equal windows meet
    under the key of their half, and a half of one i has the window itself for its key.
    """
    size = anchor_length(least)
    span = least - size
    c, mid = F.col, F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    two = F.array(F.struct(c("lo").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), c("hi").alias("hi")))
    both = standing.where(c("lo") < c("hi")).withColumn("half", F.explode(two)).drop("lo", "hi").select("*", "half.lo", "half.hi")
    fits = both.where((c("at") >= c("lo")) & (F.length("stretch") - c("at") - size >= span - c("hi")))
    core = F.substring(c("stretch"), c("at") - c("lo") + 1, c("lo") + size + span - c("hi"))
    left = F.greatest(F.lit(0), c("at") - c("hi"))
    return fits.select(
        F.xxhash64("key", "lo", "hi", core).alias("key"), "lo", "hi", "doc_id", F.transform("firsts", lambda f: f + left).alias("firsts"), (c("at") - left).alias("at"),
        F.substring(c("stretch"), left + 1, c("at") - left + size + span - c("lo")).alias("stretch"),
    )


def hot_spans(hot: DataFrame, least: int, fits: int) -> Iterator[DataFrame]:
    """(doc_id, lo, hi): shared spans among the stretches of keys with more than `fits` rows, level by level.

    Equal stretches collapse; what stands for them is split by further characters, in halves, until a key fits into a shard and its stretches go
    through the automaton. Keys that only one document has end. After at most log2(least) levels a key is a whole window, whose stretches are all equal.
    """
    rows = hot.withColumns({"lo": F.lit(0), "hi": F.lit(least - anchor_length(least))})
    while not rows.isEmpty():
        spans, standing = collapsed(rows)
        part = cut(halves(standing, least))
        sizes = cut(part.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("a") != F.col("b")).select("key", "n"))
        kept = skew_safe_lookup(part, sizes, ["key"], "doc_id", "n")
        yield spans
        yield shard_spans(kept.where(F.col("n") <= fits), least)
        rows = cut(kept.where(F.col("n") > fits).drop("n"))


def covered(spans: Column) -> Column:
    """Characters in the union of an array of (lo, hi)."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("int").alias("end"))

    def add(acc: Column, s: Column) -> Column:
        return F.struct((acc["n"] + F.greatest(F.lit(0), s["hi"] - F.greatest(s["lo"], acc["end"]))).cast("long").alias("n"), F.greatest(acc["end"], s["hi"]).alias("end"))

    return F.aggregate(F.array_sort(spans), start, add, lambda acc: acc["n"])


def shared_spans(documents: DataFrame, least: int = 240, fits: int = FITS) -> DataFrame:
    """(doc_id, lo, hi): stretches of at least `least` characters that stand verbatim in another document.

    Anchors are chosen by content, so any two equal stretches have an equal one. Anchors of two or more documents are joined back to
    their places; the text around each place goes to its anchor's shard, where recurring passages are confirmed, compiled
    into an automaton and located in every text of the shard. An anchor with more than `fits` places is split by the characters
    around it until its parts fit (hot_spans), and these go the same way.
    Null, empty and short texts share nothing. Rows of one doc_id are one document, copies of a row change nothing; a stretch that
    a document repeats in itself only is not shared. Spans may overlap.
    """
    texts = documents.where(F.col("doc_id").isNotNull() & (F.length("text") >= least)).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = anchor_rows(texts, least)
    recurring = cut(
        found.groupBy("anchor").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b"), F.count(F.lit(1)).alias("n")).where(F.col("a") != F.col("b"))
        .select("anchor", (F.col("n") > fits).alias("hot")),
    )
    places = found.join(recurring, "anchor").groupBy("doc_id").agg(F.collect_set(F.struct("anchor", "place", "hot")).alias("places"))
    stretches = stretch_rows(texts, places, least)
    if recurring.where("hot").isEmpty():
        return shard_spans(stretches, least)
    stretches = cut(stretches)
    parts = [shard_spans(stretches.where(~F.col("hot")), least), *hot_spans(stretches.where("hot").drop("hot"), least, fits)]
    return reduce(lambda x, y: x.unionByName(y), parts)


def shared_characters(documents: DataFrame, least: int = 240, fits: int = FITS) -> DataFrame:
    """(doc_id, shared_chars): how many characters of each document stand in another one; only documents that share any."""
    spans = shared_spans(documents, least, fits).groupBy("doc_id").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    return spans.select("doc_id", covered(F.col("spans")).alias("shared_chars"))

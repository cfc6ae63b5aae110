"""Duplicates hidden by formatting: radix buckets of canonical bytes, counted in tries."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.session import cut
from bidloom.skew import skew_safe_lookup

#: Entries that one trie may hold before it is written out. It only bounds memory: a key written twice meets itself again in its bucket.
TRIE_ENTRIES = 200_000


def _decoded(text: Column) -> Column:
    """Percent-escapes as the characters that they stand for; '+' stays and malformed escapes lose their meaning."""
    safe = F.regexp_replace(F.replace(text, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.try_url_decode(safe)


def bare(text: Column) -> Column:
    """Letters, marks and numbers only, in lower case."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", "")


def canonical_id(text: Column) -> Column:
    """A written id without white space, letter case and punctuation, escapes resolved."""
    return bare(_decoded(text))


def canonical_url(url: Column) -> Column:
    """A url without white space, letter case, punctuation, escapes and the order of its query parameters; each name keeps its value."""
    plain = F.regexp_replace(url, "#[^?]*$", "")
    fragment = bare(_decoded(F.regexp_extract(url, r"(?s)#([^?]*)$", 1)))
    path = bare(_decoded(F.regexp_extract(plain, r"(?s)^([^?]*)", 1)))
    query = F.regexp_extract(plain, r"(?s)^[^?]*\?(.*)$", 1)

    def pair(p: Column) -> Column:
        value = F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)
        return F.concat(bare(_decoded(F.regexp_extract(p, r"(?s)^([^=]*)", 1))), F.lit("="), bare(_decoded(value)))

    pairs = F.filter(F.transform(F.split(query, "[&;]"), pair), lambda p: p != "=")
    return F.concat(path, F.lit("?"), F.array_join(F.array_sort(pairs), "&"), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")))


def canonical_bytes(*parts: Column) -> Column:
    """The parts as one byte string, with a zero byte between them."""
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, F.lit("\0"), p)
    return F.encode(out, "UTF-8")


def oversized_prefixes(keys: DataFrame, fits: int, first: int = 2) -> dict[int, list[bytes]]:
    """By depth in bytes, the prefixes of `key` that more than `fits` rows share: the radix buckets that need further bytes.

    The depth doubles from level to level, and a level looks only into the buckets that were too large at the level before. At most
    rows / fits prefixes of one depth can be oversized, so with fits >= rows / 4096 no more than 4096 reach the driver at a time.
    """
    out: dict[int, list[bytes]] = {}
    depth, inside = first, keys.select("key")
    longest = keys.agg(F.max(F.length("key"))).first()[0] or 0
    while depth <= 2 * longest:
        prefix = F.substring("key", 1, depth)
        over = [bytes(r["prefix"]) for r in inside.groupBy(prefix.alias("prefix")).count().where(F.col("count") > fits).select("prefix").collect()]
        if not over:
            break
        out[depth] = over
        inside = inside.where(prefix.isin([F.lit(p) for p in over]))
        depth *= 2
    return out


def radix_bucket(over: dict[int, list[bytes]], first: int = 2) -> Column:
    """The bucket of a key: its shortest prefix that fits."""
    depth, rule = first, None
    for depth in sorted(over):
        prefix = F.substring("key", 1, depth)
        fits, bucket = ~prefix.isin([F.lit(p) for p in over[depth]]), F.xxhash64(prefix)
        rule = F.when(fits, bucket) if rule is None else rule.when(fits, bucket)
    last = F.xxhash64(F.substring("key", 1, 2 * depth if over else first))
    return last if rule is None else rule.otherwise(last)


def _add(trie: ahocorasick.Automaton, word: str, least: int, rows: int) -> None:
    """Adds to the counter and the smallest id at the terminal of word."""
    node = trie.get(word, None)
    if node is None:
        trie.add_word(word, [least, rows])
    else:
        node[0], node[1] = min(node[0], least), node[1] + rows


def _terminals(trie: ahocorasick.Automaton) -> pd.DataFrame:
    return pd.DataFrame([(w.encode("latin-1"), least, rows) for w, (least, rows) in trie.items()], columns=["key", "least", "rows"])


def _partition_tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pre-aggregation: one trie after the other over an input partition, in any order of keys."""
    trie = ahocorasick.Automaton()
    for pdf in batches:
        for key, own in zip(pdf["key"], pdf["id"]):
            _add(trie, bytes(key).decode("latin-1"), own, 1)
        if len(trie) > TRIE_ENTRIES:
            yield _terminals(trie)
            trie = ahocorasick.Automaton()
    if len(trie):
        yield _terminals(trie)


def _bucket_tries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One trie per bucket. Rows come sorted by bucket and key, so a trie that has grown too large ends between two keys."""
    bucket, last, trie = None, None, ahocorasick.Automaton()
    for pdf in batches:
        for b, key, least, rows in zip(pdf["bucket"], pdf["key"], pdf["least"], pdf["rows"]):
            word = bytes(key).decode("latin-1")
            if b != bucket or (len(trie) > TRIE_ENTRIES and word != last):
                if len(trie):
                    yield _terminals(trie)
                bucket, trie = b, ahocorasick.Automaton()
            last = word
            _add(trie, word, least, rows)
    if len(trie):
        yield _terminals(trie)


def counted_keys(keyed: DataFrame, least_fit: int = 100_000) -> DataFrame:
    """(key, least, rows): each canonical key once, with the smallest id and the number of its rows.

    keyed has key (bytes) and id (long). Copies collapse in a trie per input partition before anything is shuffled, so a key that holds
    any share of all rows arrives once per partition. Radix buckets of the key bytes are split by further bytes until each
    holds at most max(least_fit, rows / 4096) of those; then every bucket is counted in tries with counters at their terminals.
    """
    local = cut(keyed.select("key", "id").mapInPandas(_partition_tries, "key binary, least long, rows long"))
    fits = max(least_fit, local.count() // 4096)
    placed = local.withColumn("bucket", radix_bucket(oversized_prefixes(local, fits)))
    return placed.repartition("bucket").sortWithinPartitions("bucket", "key").mapInPandas(_bucket_tries, "key binary, least long, rows long")


def formatted_copies(records: DataFrame, id_column: str, key: Column, least_fit: int = 100_000) -> DataFrame:
    """(kept, copy, copies): one row per record that equals another by its canonical bytes, except the one with the smallest id.

    copies is the number of rows of the set, the kept one included. Rows with a null id or key have no copies. Sets of any size keep
    all their rows: large ones are salted when the rows look up their set. A row that comes twice under one id is no copy of itself. Empty and
    very long texts have keys like others; columns of other names change nothing; an empty table gives none.
    """
    # Tries, the count and the lookup all read the keys: written once, a row is brought to its canonical form once.
    keyed = cut(records.select(F.col(id_column).cast("long").alias("id"), key.alias("key")).where(F.col("id").isNotNull() & F.col("key").isNotNull()))
    sets = cut(counted_keys(keyed, least_fit).where(F.col("rows") > 1))
    found = skew_safe_lookup(keyed, sets, ["key"], "id", "rows")
    return found.where(F.col("id") != F.col("least")).select(F.col("least").alias("kept"), F.col("id").alias("copy"), F.col("rows").alias("copies"))


def tender_key() -> Column:
    """Canonical bytes of a tender: its id and url; null if either is null."""
    return canonical_bytes(canonical_id(F.col("tender_id")), canonical_url(F.col("url")))

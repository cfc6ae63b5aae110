"""Mixing sources to target shares of tokens by entropy balancing."""

from __future__ import annotations

import base64
import math
import os
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.session import cut

#: Where the public vocabularies are; a parameter of every query that counts tokens.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

#: Fixed value: the public pattern that splits text before the merges of byte-level BPE vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Steps of the rounding threshold that are told apart.
STEPS = 4096

_encoders: dict[str, object] = {}


def _encoder(name: str):
    """The tokenizer of a rank file that was sent to the executors, one per worker."""
    if name not in _encoders:
        import tiktoken

        with open(SparkFiles.get(name), "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        _encoders[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[name]


def token_sizes(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens): the tokens of each whole text. Null texts are left out.

    The rank file needs to be on the driver's machine only; Spark sends it to the executors.
    """
    documents.sparkSession.sparkContext.addFile(vocabulary)
    name = os.path.basename(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = _encoder(name).encode_ordinary
        for pdf in batches:
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "source": pdf["source"], "n_tokens": [len(encode(t)) for t in pdf["text"]]})

    own = documents.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    return own.mapInPandas(count, "doc_id long, source string, n_tokens long")


@dataclass
class Goal:
    """What one source has to give."""

    share: float
    repeats: int
    tokens: float = 0.0
    goal: float = 0.0
    tilt: float = 0.0


def _by_source(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("source")]


def _rate(goals: dict[str, Goal]) -> Column:
    """exp(tilt x tokens), at most the source's repeats."""
    tilt, cap = _by_source({s: g.tilt for s, g in goals.items()}), _by_source({s: float(g.repeats) for s, g in goals.items()})
    return F.when(tilt == math.inf, cap).otherwise(F.least(cap, F.exp(F.least(F.lit(50.0), tilt * F.col("n_tokens")))))


def solve_tilts(histogram: DataFrame, goals: dict[str, Goal], rounds: int = 60, tolerance: float = 1e-6) -> None:
    """Newton iterations on the dual, one variable per source: sum of rate x tokens = goal.

    Each round is one aggregation of the histogram (source, n_tokens, docs) to a row per source: the tokens that the present tilts give and
    their derivative. The dual is convex in each tilt, so a step that leaves the known bracket is replaced by its middle.
    """
    low = {s: -math.inf for s in goals}
    high = {s: math.inf for s in goals}
    active = set()
    for s, g in goals.items():
        if g.goal >= g.repeats * g.tokens * (1 - 1e-12):
            g.tilt = math.inf
        else:
            active.add(s)
    t = F.col("n_tokens").cast("double")
    for _ in range(rounds):
        if not active:
            return
        rate = _rate(goals)
        free = F.when(rate < _by_source({s: float(g.repeats) for s, g in goals.items()}), rate * t * t).otherwise(0.0)
        sums = histogram.groupBy("source").agg(F.sum(F.col("docs") * rate * t).alias("given"), F.sum(F.col("docs") * free).alias("slope"))
        for r in sums.collect():
            s, g = r["source"], goals[r["source"]]
            if s not in active:
                continue
            miss = r["given"] - g.goal
            if abs(miss) <= tolerance * g.goal:
                active.discard(s)
                continue
            if miss > 0:
                high[s] = g.tilt
            else:
                low[s] = g.tilt
            step = g.tilt - miss / r["slope"] if r["slope"] > 0 else math.nan
            if not low[s] < step < high[s]:
                if math.isinf(low[s]) or math.isinf(high[s]):
                    step = g.tilt + (1e-4 if miss < 0 else -1e-4) + g.tilt * (1 if g.tilt * miss < 0 else -0.5)
                else:
                    step = (low[s] + high[s]) / 2
            g.tilt = step


def mixture(documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, vocabulary: str = VOCABULARY, most_sources: int = 10_000) -> tuple[DataFrame, dict[str, Goal]]:
    """((doc_id, source, n_tokens, copies), goals): copies of each document so that tokens by source follow the target shares.

    Rates are the closest to one copy each, in entropy, that meet the token goals: exponentially tilted by a document's tokens, at most
    max_repeats. They become whole copies by a threshold from the hash of doc_id, shifted per source so that the rounded
    tokens meet the goal as well. total_tokens is the size of the corpus, by default the largest that the repeats allow.
    Target sources without documents can't be met: the other shares are scaled to sum to one. Documents of sources without a target, of
    null source, null text or no tokens get no copies. targets is a fixed table of one row per source (rows of one source add up,
    the largest max_repeats holds, null counts as 1); it may have up to most_sources rows.
    """
    wanted = targets.where((F.col("target_share") > 0) & F.col("source").isNotNull()).groupBy("source").agg(
        F.sum("target_share").alias("share"), F.coalesce(F.max("max_repeats"), F.lit(1)).alias("repeats"),
    )
    rows = wanted.limit(most_sources + 1).collect()
    if len(rows) > most_sources:
        raise ValueError(f"more than {most_sources} target sources")
    goals = {r["source"]: Goal(r["share"], max(1, r["repeats"])) for r in rows}
    own = documents.where(F.col("source").isin(list(goals))) if goals else documents.where(F.lit(False))
    sizes = cut(token_sizes(own, vocabulary).where(F.col("n_tokens") > 0))
    # One row per source and length; T tokens have at most sqrt(2 T) different lengths. In few parts, so that a round is a small job.
    histogram = sizes.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("docs")).coalesce(8).persist()
    for r in histogram.groupBy("source").agg(F.sum(F.col("docs") * F.col("n_tokens")).alias("tokens")).collect():
        goals[r["source"]].tokens = float(r["tokens"])
    there = {s: g for s, g in goals.items() if g.tokens > 0}
    whole = sum(g.share for g in there.values())
    if there:
        most = min(g.repeats * g.tokens * whole / g.share for g in there.values())
        total = most if total_tokens is None else min(float(total_tokens), most)
        for g in there.values():
            g.goal = total * g.share / whole
        solve_tilts(histogram, there)
    histogram.unpersist()
    if not there:
        return sizes.withColumn("copies", F.lit(0)).where(F.lit(False)), goals
    return _rounded(sizes, there), goals


def _rounded(sizes: DataFrame, goals: dict[str, Goal]) -> DataFrame:
    """Whole copies: floor(rate + u + shift), with u in [0, 1) from the hash of doc_id and one shift per source.

    A document gains a copy when the shift passes 1 - frac(rate + u). One aggregation sums the tokens that are gained in each of STEPS steps
    (at most sources x STEPS rows); the step where they make up what the plain rounding lacks is the shift.
    """
    cap = _by_source({s: float(g.repeats) for s, g in goals.items()})
    u = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(20)), 11) / F.lit(float(1 << 53))
    placed = sizes.withColumn("at", _rate(goals) + u)
    lower = placed.withColumn("at", F.col("at") - 0.5)  # shifts from -1/2 to 1/2
    step = F.floor((1 - (F.col("at") - F.floor("at"))) * STEPS).cast("int")
    whole = F.floor("at")
    gains = lower.groupBy("source", step.alias("step")).agg(
        F.sum(F.when((whole + 1 <= cap) & (whole + 1 >= 1), F.col("n_tokens")).otherwise(0)).alias("gain"),
        F.sum(F.greatest(F.lit(0), F.least(cap, whole)) * F.col("n_tokens")).alias("base"),
    )
    table: dict[str, list] = {}
    for r in gains.collect():
        table.setdefault(r["source"], []).append((r["step"], float(r["gain"]), float(r["base"])))
    shift = {}
    for s, g in goals.items():
        own = sorted(table.get(s, []))
        given = sum(b for _, _, b in own)
        best = (abs(given - g.goal), 0.0)
        for k, gain, _ in own:
            given += gain
            best = min(best, (abs(given - g.goal), (k + 1) / STEPS))
        shift[s] = best[1]
    copies = F.greatest(F.lit(0), F.least(cap, F.floor(F.col("at") + _by_source(shift)))).cast("int")
    return lower.select("doc_id", "source", "n_tokens", copies.alias("copies")).where(F.col("copies") > 0)


def share_report(corpus: DataFrame, goals: dict[str, Goal]) -> DataFrame:
    """One row per target source: (source, target_share, max_repeats, documents, copies, most_copies, tokens, share)."""
    spark = corpus.sparkSession
    wanted = spark.createDataFrame([(s, g.share, g.repeats) for s, g in sorted(goals.items())], "source string, target_share double, max_repeats int")
    used = corpus.groupBy("source").agg(
        F.count(F.lit(1)).alias("documents"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"),
    )
    rows = wanted.join(used, "source", "left").na.fill(0, ["documents", "copies", "most_copies", "tokens"])
    total = rows.groupBy().agg(F.sum("tokens")).first()[0] or 0
    return rows.withColumn("share", F.col("tokens") / F.lit(float(max(1, total))))

"""Versions of files: current one, numbering, change detection, integrity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.skew import with_slices

#: Roles of attachments that are files.
FILE_ROLES = ("Tender Item List", "Terms & Conditions", "Tender Preliminary Result", "Tender Final Result", "Additional Attachments", "Objection to the Results")


def current_versions(files: DataFrame, key: tuple[str, ...] = ("post_id", "role"), version: str = "version", tie: str = "id") -> DataFrame:
    """The row with the highest version of every key, of equal ones that with the greatest tie. One aggregation that combines on the map side."""
    others = [c for c in files.columns if c not in key]
    best = files.groupBy(*key).agg(F.max_by(F.struct(*others), F.struct(version, tie)).alias("r"))
    return best.select(*key, *[F.col(f"r.{c}").alias(c) for c in others]).select(*files.columns)


def number_versions(seen: DataFrame, key: tuple[str, ...] = ("post_id", "role"), digest: str = "content_sha256", at: str = "seen_at", tie: str = "id", least: int = 10_000) -> DataFrame:
    """(key, version, digest, first_seen_at, last_seen_at, first_of_key, is_current) of sightings: a new version begins where the content differs from the sighting before.

    Sightings apply in the order of their instants, then `tie`; unreadable instants come first. first_of_key is the first sighting of the key, carried to all versions.
    A null digest is content of its own. A key that holds a large share of all sightings is cut into slices of time: each begins with the last content of the slice
    before it and counts on from the versions before it. Rows with a null key are left out.
    """
    keys = list(key)
    rows = seen.select(*keys, digest, at, tie, F.coalesce(F.unix_micros(F.try_to_timestamp(at)), F.lit(-(2**62))).alias("order_at")).dropna(subset=keys)
    rows, sliced = with_slices(rows, keys, "order_at", tie, least=least)
    rows = rows.withColumn("carried", F.lit(False))
    part = [*keys, "slice_no"]
    if sliced:
        ends = rows.groupBy(*part).agg(F.max_by(digest, F.struct("order_at", tie)).alias(digest))
        to = F.lead("slice_no").over(Window.partitionBy(*keys).orderBy("slice_no"))
        rows = rows.unionByName(ends.withColumn("slice_no", to).where(F.col("slice_no").isNotNull()).withColumn("carried", F.lit(True)), allowMissingColumns=True)
    order = Window.partitionBy(*part).orderBy(F.col("carried").desc(), "order_at", tie)
    begins = (~F.col("carried") & ((F.row_number().over(order) == 1) | ~F.col(digest).eqNullSafe(F.lag(digest).over(order)))).cast("int")
    steps = rows.select(*part, digest, at, "order_at", tie, "carried", begins.alias("begins"))
    numbered = steps.withColumn("version", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0))).where(~F.col("carried"))
    if sliced:
        counts = steps.groupBy(*part).agg(F.sum("begins").alias("n"))
        earlier = F.sum("n").over(Window.partitionBy(*keys).orderBy("slice_no").rowsBetween(Window.unboundedPreceding, -1))
        numbered = numbered.join(counts.select(*part, F.coalesce(earlier, F.lit(0)).alias("earlier")), part).withColumn("version", F.col("version") + F.col("earlier"))
    spans = numbered.groupBy(*keys, "version").agg(F.first(digest).alias(digest), F.min(at).alias("first_seen_at"), F.max(at).alias("last_seen_at"))
    totals = numbered.groupBy(*keys).agg(F.min(at).alias("first_of_key"), F.max("version").alias("newest"))
    return spans.join(totals, keys).select(
        *keys, F.col("version").cast("int").alias("version"), digest, "first_seen_at", "last_seen_at", "first_of_key", (F.col("version") == F.col("newest")).cast("int").alias("is_current"),
    )


def document_states(stored: DataFrame, incoming: DataFrame, at: str, key: tuple[str, ...] = ("post_id", "role"), digest: str = "content_sha256") -> DataFrame:
    """(key, state, version, digest, first_seen_at, last_seen_at) after a delivery of documents known by their hash.

    same: the current hash comes again, only last_seen_at moves. changed: another hash, version + 1, the old one retires. new: no version
    yet. kept: not delivered. stored has one current row per key; of several deliveries of a key the greatest hash stands.
    """
    current = stored.where(F.col("is_current") == 1).select(*key, F.col(digest).alias("old"), "version", "first_seen_at", "last_seen_at")
    news = incoming.groupBy(*key).agg(F.max(digest).alias("new"), F.lit(True).alias("came"))
    both = current.join(news, list(key), "full_outer")
    state = F.when(F.col("came").isNull(), "kept").when(F.col("version").isNull(), "new").when(F.col("old").eqNullSafe(F.col("new")), "same").otherwise("changed")
    return both.withColumn("state", state).select(
        *key, "state", F.when(F.col("state") == "new", 1).when(F.col("state") == "changed", F.col("version") + 1).otherwise(F.col("version")).cast("int").alias("version"),
        F.when(F.col("state").isin("new", "changed"), F.col("new")).otherwise(F.col("old")).alias(digest),
        F.coalesce("first_seen_at", F.lit(at)).alias("first_seen_at"), F.when(F.col("state") == "kept", F.col("last_seen_at")).otherwise(at).alias("last_seen_at"),
    )


def signals_unchanged(old: dict[str, Column], new: dict[str, Column]) -> Column:
    """Whether the signals of a HEAD request say that a file is unchanged: none that both sides have differs, and there is at least one."""
    known = [old[s].isNotNull() & new[s].isNotNull() for s in old]
    equal = [F.when(k, old[s].cast("string") == new[s].cast("string")).otherwise(F.lit(True)) for k, s in zip(known, old)]
    every, some = equal[0], known[0]
    for e, k in zip(equal[1:], known[1:]):
        every, some = every & e, some | k
    return every & some


def reconcile(stored: DataFrame, probes: DataFrame, key: tuple[str, ...] = ("post_id", "role")) -> DataFrame:
    """(key, state, reason) of each probed file, by the cheapest signal that decides: no stored version -> new; an error; a moved address; HEAD signals
    (etag, time, size); at last the hash of the bytes. States: new, changed, same, error.

    probes: (key, url, etag, http_last_modified, size_bytes, content_sha256, error); bytes are hashed only where they were fetched.
    """
    fields = ("url", "etag", "http_last_modified", "size_bytes", "content_sha256")
    old = stored.select(*key, F.struct(*fields).alias("o"))
    both = probes.select(*key, F.struct(*fields, "error").alias("n")).join(old, list(key), "left")
    signals = ("etag", "http_last_modified", "size_bytes")
    quiet = (F.col("o.url").eqNullSafe(F.col("n.url"))) & signals_unchanged({s: F.col(f"o.{s}") for s in signals}, {s: F.col(f"n.{s}") for s in signals})
    failed = F.col("n.error").isNotNull() | (F.col("n.content_sha256").isNull() & ~quiet)
    same_bytes = F.col("o.content_sha256") == F.col("n.content_sha256")
    case = (
        F.when(F.col("n.error").isNotNull(), F.struct(F.lit("error").alias("state"), F.lit("request").alias("reason")))
        .when(F.col("o").isNull() & F.col("n.content_sha256").isNull(), F.struct(F.lit("error").alias("state"), F.lit("no bytes").alias("reason")))
        .when(F.col("o").isNull(), F.struct(F.lit("new").alias("state"), F.lit("first version").alias("reason")))
        .when(quiet, F.struct(F.lit("same").alias("state"), F.lit("signals").alias("reason")))
        .when(failed, F.struct(F.lit("error").alias("state"), F.lit("no bytes").alias("reason")))
        .when(same_bytes, F.struct(F.lit("same").alias("state"), F.lit("bytes").alias("reason")))
        .otherwise(F.struct(F.lit("changed").alias("state"), F.lit("bytes").alias("reason")))
    )
    return both.select(*key, case.alias("c")).select(*key, "c.state", "c.reason")


def file_counts(states: DataFrame, roles: tuple[str, ...] = FILE_ROLES) -> DataFrame:
    """(post_id, checked, new, changed, same, errors) of reconciled files; other roles than files don't count."""
    n = lambda s: F.count_if(F.col("state") == s)
    return states.where(F.col("role").isin(*roles)).groupBy("post_id").agg(
        F.count(F.lit(1)).alias("checked"), n("new").alias("new"), n("changed").alias("changed"), n("same").alias("same"), n("error").alias("errors"),
    )


def audit(manifest: DataFrame, archive: DataFrame) -> DataFrame:
    """(id, local_path, verdict): ok, missing, wrong size or wrong hash, of files that should lie in the archive.

    archive: (path, length, content) as binaryFile reads it; manifest: (id, local_path, size_bytes, content_sha256). Unknown sizes and
    hashes aren't held against a file.
    """
    found = archive.select(F.col("path").alias("local_path"), F.col("length").alias("found_size"), F.sha2("content", 256).alias("found_hash"))
    verdict = (
        F.when(F.col("found_size").isNull(), "missing").when(F.col("size_bytes") != F.col("found_size"), "wrong size")
        .when(F.lower("content_sha256") != F.col("found_hash"), "wrong hash").otherwise("ok")
    )
    return manifest.where(F.col("local_path").isNotNull()).join(found, "local_path", "left").select("id", "local_path", verdict.alias("verdict"))


def relative_paths(files: DataFrame, root: str, column: str = "local_path") -> DataFrame:
    """Absolute paths below root become relative to it; others stay."""
    prefix = root.rstrip("/") + "/"
    return files.withColumn(column, F.when(F.col(column).startswith(prefix), F.expr(f"substring({column}, {len(prefix) + 1})")).otherwise(F.col(column)))

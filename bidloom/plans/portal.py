"""Queries over the portal tables, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.functions import classify
from bidloom.functions import scalars as X
from bidloom.operators import discovery, marts, runs, search, upsert, versions
from bidloom.operators.snapshots import standing_rows
from bidloom.schemas import conform
from bidloom.session import table
from bidloom.sources import lines, portal_html, portal_json, sinks, tables, tabular

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2026-09-01"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL if there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _some(spark: SparkSession, d: str, *names: str) -> list[DataFrame]:
    return [table(spark, d, n) for n in names]


def _current(spark: SparkSession, d: str) -> DataFrame:
    return marts.current_items(*_some(spark, d, "tender_items", "attachments", "tenders"))


# Parts of the oracles.
_ITEMS = "(SELECT DISTINCT * FROM tender_items)"
_FILES = "(SELECT DISTINCT * FROM attachments)"
_CURRENT = f"""(SELECT i.id, i.post_id, t.tender_id, i.nupco_code, i.description, i.uom, i.qty, i.category_guess, i.is_accessory, i.attachment_id, a.filename,
  t.title_en, t.status_label, t.submission_ts, t.opening_ts, COALESCE(t.country, 'SA') AS country, t.is_terminal, t.days_to_deadline
  FROM {_ITEMS} i JOIN {_FILES} a ON a.id = i.attachment_id AND a.is_current = 1 JOIN tenders t ON t.post_id = i.post_id)"""
_OPEN = "(is_terminal = 0 AND (days_to_deadline IS NULL OR days_to_deadline >= 0))"
_CATALOGUE = f"""(SELECT nupco_code, MIN(description) AS description, COUNT(DISTINCT tender_id) AS tender_count, COUNT(*) AS line_count, SUM(COALESCE(qty, 0)) AS total_qty,
  MAX(category_guess) AS category, MAX(submission_ts) AS latest_deadline, COALESCE(STRING_AGG(DISTINCT tender_id, ',' ORDER BY tender_id), '') AS tender_ids
  FROM {_CURRENT} WHERE nupco_code IS NOT NULL AND nupco_code <> '' GROUP BY nupco_code)"""


# --- marts ---


@query(f"SELECT * FROM {_CURRENT}")
def current_items(spark: SparkSession, d: str) -> DataFrame:
    return _current(spark, d)


@query(f"SELECT * REPLACE (ROUND(total_qty, 3) AS total_qty) FROM {_CATALOGUE}")
def item_catalogue(spark: SparkSession, d: str) -> DataFrame:
    return marts.catalogue(_current(spark, d)).withColumn("total_qty", F.round("total_qty", 3))


@query(f"SELECT nupco_code, tender_count, line_count FROM {_CATALOGUE} ORDER BY tender_count DESC NULLS LAST, line_count DESC NULLS LAST, nupco_code LIMIT 50")
def catalogue_page(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.catalogue(_current(spark, d)).select("nupco_code", "tender_count", "line_count")
    return marts.page(rows, (("tender_count", False), ("line_count", False)), "nupco_code", 50)


@query(f"""SELECT c.nupco_code, c.description, c.line_count FROM {_CATALOGUE} c WHERE c.nupco_code IN
  (SELECT nupco_code FROM tender_items WHERE len(list_filter(regexp_extract_all(lower(description), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+'), lambda w: starts_with(w, 'syr'))) > 0)""")
def catalogue_matched(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "tender_items").select("id", "nupco_code", "description")
    codes = items.join(search.search(items, "id", F.col("description"), "syr"), "id", "left_semi").select("nupco_code")
    return marts.catalogue(_current(spark, d)).join(codes, "nupco_code", "left_semi").select("nupco_code", "description", "line_count")


@query(f"""SELECT tender_id, post_id, id, description, uom, qty, status_label, submission_ts FROM {_CURRENT}
  WHERE nupco_code = (SELECT nupco_code FROM {_CATALOGUE} ORDER BY line_count DESC, nupco_code LIMIT 1)""")
def code_lines(spark: SparkSession, d: str) -> DataFrame:
    """All lines of the code with the most lines."""
    current = _current(spark, d)
    top = marts.catalogue(current).orderBy(F.desc("line_count"), "nupco_code").limit(1).select("nupco_code")
    return current.join(F.broadcast(top), "nupco_code", "left_semi").select("tender_id", "post_id", "id", "description", "uom", "qty", "status_label", "submission_ts")


@query(f"SELECT post_id, tender_id, status_label, days_to_deadline FROM tenders WHERE {_OPEN}")
def open_tenders(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tenders").where(marts.is_open()).select("post_id", "tender_id", "status_label", "days_to_deadline")


@query("""SELECT h.id, h.changed_at, h.change_kind, h.tender_id, h.post_id, h.field, h.old_value, h.new_value, t.title_en, t.status_label AS tender_status, t.url
  FROM (SELECT DISTINCT * FROM tender_history) h LEFT JOIN tenders t ON t.post_id = h.post_id WHERE h.change_kind = 'update' ORDER BY h.id DESC LIMIT 100""")
def recent_changes(spark: SparkSession, d: str) -> DataFrame:
    return marts.recent_changes(*_some(spark, d, "tender_history", "tenders"), kind="update")


@query("""SELECT h.id, h.post_id, h.field, h.change_kind, t.title_en, t.url FROM (SELECT DISTINCT * FROM tender_history) h LEFT JOIN tenders t ON t.post_id = h.post_id""")
def change_feed(spark: SparkSession, d: str) -> DataFrame:
    history, tenders = _some(spark, d, "tender_history", "tenders")
    return history.select("id", "post_id", "field", "change_kind").dropDuplicates(["id"]).join(tenders.select("post_id", "title_en", "url"), "post_id", "left").select("id", "post_id", "field", "change_kind", "title_en", "url")


@query(f"""SELECT (SELECT COUNT(*) FROM tenders) AS tenders, (SELECT COUNT(*) FROM tenders WHERE is_listed = 1) AS listed, (SELECT COUNT(*) FROM tenders WHERE {_OPEN}) AS open_tenders,
  (SELECT COUNT(*) FROM tender_items) AS items_all_versions, (SELECT COUNT(DISTINCT nupco_code) FROM tender_items) + (SELECT COUNT(DISTINCT rdl_code) FROM tender_items) AS codes,
  (SELECT COUNT(*) FROM attachments WHERE is_current = 1) AS files, (SELECT COUNT(*) FROM attachments WHERE parse_status = 'failed') AS parse_failed,
  (SELECT COUNT(*) FROM tender_history) AS changes""")
def stats(spark: SparkSession, d: str) -> DataFrame:
    return marts.summary(*_some(spark, d, "tenders", "tender_items", "attachments", "tender_history"))


@query("SELECT COALESCE(status_label, '(none)') AS label, COUNT(*) AS n FROM tenders GROUP BY 1")
def by_status(spark: SparkSession, d: str) -> DataFrame:
    return marts.by_status(table(spark, d, "tenders"))


@query(f"SELECT COALESCE(country, 'SA') AS country, COUNT(*) AS tenders, COUNT(*) FILTER (WHERE {_OPEN}) AS open_tenders FROM tenders GROUP BY 1")
def by_country(spark: SparkSession, d: str) -> DataFrame:
    return marts.by_country(table(spark, d, "tenders"))


@query(f"""SELECT t.post_id, COALESCE(i.n, 0) AS item_count, ROUND(i.q, 3) AS total_qty, COALESCE(f.n, 0) AS attachment_count FROM tenders t
  LEFT JOIN (SELECT a.post_id, COUNT(*) AS n, SUM(i.qty) AS q FROM {_ITEMS} i JOIN {_FILES} a ON a.id = i.attachment_id AND a.is_current = 1 GROUP BY 1) i ON i.post_id = t.post_id
  LEFT JOIN (SELECT post_id, COUNT(*) AS n FROM {_FILES} WHERE is_current = 1 GROUP BY 1) f ON f.post_id = t.post_id""")
def tender_rollup(spark: SparkSession, d: str) -> DataFrame:
    return marts.rollup(*_some(spark, d, "tenders", "tender_items", "attachments")).withColumn("total_qty", F.round("total_qty", 3))


@query(f"""SELECT t.post_id, COALESCE(b.category_guess, t.category_guess) AS category_guess FROM tenders t LEFT JOIN
  (SELECT post_id, category_guess, ROW_NUMBER() OVER (PARTITION BY post_id ORDER BY COUNT(*) DESC, category_guess) AS k FROM {_CURRENT}
   WHERE COALESCE(is_accessory, 0) = 0 AND category_guess IS NOT NULL GROUP BY post_id, category_guess) b ON b.post_id = t.post_id AND b.k = 1""")
def modal_category(spark: SparkSession, d: str) -> DataFrame:
    return marts.modal_category(table(spark, d, "tenders"), _current(spark, d))


@query(f"SELECT id, tender_id, qty, submission_ts FROM {_CURRENT} WHERE country = 'JO' ORDER BY submission_ts DESC NULLS LAST, id LIMIT 200 OFFSET 10")
def items_page(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.filtered(_current(spark, d), country="jo").select("id", "tender_id", "qty", "submission_ts")
    return marts.page(rows, marts.pick_sort("deadline_desc", marts.SORTS, False), "id", 200, 10)


@query("SELECT post_id, tender_id, opening_ts FROM tenders WHERE status_label = 'Cancelled' ORDER BY opening_ts DESC NULLS LAST, post_id LIMIT 500")
def tenders_page(spark: SparkSession, d: str) -> DataFrame:
    rows = marts.filtered(table(spark, d, "tenders"), status="Cancelled", country="XX").select("post_id", "tender_id", "opening_ts")
    return marts.page(rows, marts.pick_sort("relevance", marts.SORTS, False), "post_id", 10_000)


def _orders_sql(rows: str, sorts: dict, key: str, limit: int) -> str:
    by = lambda order: ", ".join(f"{c} {'ASC' if up else 'DESC'} NULLS LAST" for c, up in order)
    return " UNION ALL ".join(f"SELECT * FROM (SELECT '{name}' AS sort, {key} FROM {rows} ORDER BY {by(order)}, {key} LIMIT {limit})" for name, order in sorts.items())


def _orders(rows: DataFrame, sorts: dict, key: str, limit: int) -> DataFrame:
    pages = [marts.page(rows, order, key, limit).select(F.lit(name).alias("sort"), key) for name, order in sorts.items()]
    return reduce(lambda a, b: a.unionByName(b), pages)


@query(_orders_sql(_CURRENT, marts.SORTS, "id", 40))
def item_orders(spark: SparkSession, d: str) -> DataFrame:
    """The first lines under each order that items can be asked for."""
    return _orders(_current(spark, d), marts.SORTS, "id", 40)


@query(_orders_sql(_CATALOGUE, marts.CATALOGUE_SORTS, "nupco_code", 40))
def catalogue_orders(spark: SparkSession, d: str) -> DataFrame:
    """The first codes under each order of the catalogue."""
    return _orders(marts.catalogue(_current(spark, d)).withColumn("total_qty", F.round("total_qty", 3)), marts.CATALOGUE_SORTS, "nupco_code", 40)


@query(f"SELECT id, qty FROM {_CURRENT} WHERE is_accessory = 0 AND category_guess = 'device'")
def without_accessories(spark: SparkSession, d: str) -> DataFrame:
    return marts.filtered(_current(spark, d), category="device", hide_accessories=True).select("id", "qty")


_PAGE_TENDERS = f"""SELECT t.post_id, COALESCE((SELECT STRING_AGG(a.id::VARCHAR, ',' ORDER BY a.role NULLS FIRST, a.id) FROM {_FILES} a WHERE a.post_id = t.post_id AND a.is_current = 1), '') AS files,
  COALESCE(n.n, 0) AS item_total, COALESCE(n.ids, '') AS items, COALESCE(h.ids, '') AS changes, COALESCE(w.ids, '') AS awards FROM tenders t
  LEFT JOIN (SELECT post_id, COUNT(*) AS n, STRING_AGG(id::VARCHAR, ',' ORDER BY k) FILTER (WHERE k <= 1000) AS ids FROM (SELECT i.post_id, i.id, ROW_NUMBER() OVER (PARTITION BY i.post_id ORDER BY i.source_page NULLS FIRST, i.row_index NULLS FIRST, i.id) AS k
    FROM {_ITEMS} i WHERE i.attachment_id IN (SELECT id FROM attachments WHERE is_current = 1)) GROUP BY post_id) n ON n.post_id = t.post_id
  LEFT JOIN (SELECT post_id, STRING_AGG(id::VARCHAR, ',' ORDER BY k) AS ids FROM (SELECT post_id, id, ROW_NUMBER() OVER (PARTITION BY post_id ORDER BY TRY_CAST(changed_at AS TIMESTAMPTZ) DESC NULLS LAST, id DESC) AS k
    FROM (SELECT DISTINCT * FROM tender_history)) WHERE k <= 100 GROUP BY post_id) h ON h.post_id = t.post_id
  LEFT JOIN (SELECT m.post_id, STRING_AGG(l_orderkey || '-' || l_linenumber, ',' ORDER BY lpad(l_orderkey::VARCHAR, 12, '0'), l_linenumber, l_suppkey) AS ids FROM lineitem
    JOIN tenders m ON m.post_id % 60000 = l_orderkey GROUP BY m.post_id) w ON w.post_id = t.post_id"""


@query()
def tender_pages(spark: SparkSession, d: str) -> DataFrame:
    """A tender's page: its files by role, lines by page and row, the latest changes, and award lines, for which orders stand by the rest of the tender's key."""
    tenders, attachments, items, history, lines = _some(spark, d, "tenders", "attachments", "tender_items", "tender_history", "lineitem")
    own = tenders.select("post_id", F.pmod("post_id", F.lit(60_000)).alias("l_orderkey"))
    awards = lines.join(own, "l_orderkey").select(
        "post_id", F.lpad(F.col("l_orderkey").cast("string"), 12, "0").alias("award_no"), F.col("l_linenumber").alias("item_no"), F.col("l_suppkey").alias("beneficiary"),
        X.unit_cost(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_cost"),
    )
    return marts.tender_page(tenders, attachments, items, history, awards)


@query(_PAGE_TENDERS)
def tender_detail(spark: SparkSession, d: str) -> DataFrame:
    """The nested lists of all tender pages, as the ids in their order."""
    ids = lambda c: F.array_join(F.transform(c, lambda r: r["id"].cast("string")), ",").alias(c)
    awards = F.transform("awards", lambda r: F.concat_ws("-", r["award_no"].cast("long").cast("string"), r["item_no"].cast("string")))
    return tender_pages(spark, d).select("post_id", ids("files"), "item_total", ids("items"), ids("changes"), F.array_join(awards, ",").alias("awards"))


# --- versions ---


@query(f"SELECT * EXCLUDE k FROM (SELECT id, post_id, role, version, content_sha256, ROW_NUMBER() OVER (PARTITION BY post_id, role ORDER BY version DESC, id DESC) AS k FROM {_FILES}) WHERE k = 1")
def current_version(spark: SparkSession, d: str) -> DataFrame:
    return versions.current_versions(table(spark, d, "attachments").select("id", "post_id", "role", "version", "content_sha256"))


@query(f"""WITH s AS (SELECT *, CASE WHEN ROW_NUMBER() OVER w = 1 OR content_sha256 IS DISTINCT FROM LAG(content_sha256) OVER w THEN 1 ELSE 0 END AS new
    FROM {_FILES} WINDOW w AS (PARTITION BY post_id, role ORDER BY first_seen_at, id)),
  n AS (SELECT *, SUM(new) OVER (PARTITION BY post_id, role ORDER BY first_seen_at, id ROWS UNBOUNDED PRECEDING) AS v FROM s),
  g AS (SELECT post_id, role, v, MIN(content_sha256) AS content_sha256, MIN(first_seen_at) AS first_seen_at, MAX(first_seen_at) AS last_seen_at FROM n GROUP BY 1, 2, 3)
  SELECT post_id, role, CAST(v AS INTEGER) AS version, content_sha256, first_seen_at, last_seen_at, MIN(first_seen_at) OVER (PARTITION BY post_id, role) AS first_of_key,
  CAST(v = MAX(v) OVER (PARTITION BY post_id, role) AS INTEGER) AS is_current FROM g""")
def version_chain(spark: SparkSession, d: str) -> DataFrame:
    seen = table(spark, d, "attachments").select("id", "post_id", "role", "content_sha256", F.col("first_seen_at").alias("seen_at")).dropDuplicates(["id"])
    return versions.number_versions(seen)


_STORED = f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY post_id, role ORDER BY version DESC, id DESC) AS k FROM {_FILES} WHERE is_current = 1) WHERE k = 1)"
_OLDER = f"(SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY post_id, role ORDER BY version DESC, id DESC) AS k FROM {_FILES} WHERE is_current = 0) WHERE k = 1)"


def _stored_and_older(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    files = table(spark, d, "attachments")
    return tuple(versions.current_versions(files.where(F.col("is_current") == flag)) for flag in (1, 0))


@query(f"""SELECT COALESCE(s.post_id, o.post_id) AS post_id, COALESCE(s.role, o.role) AS role,
  CASE WHEN o.id IS NULL THEN 'kept' WHEN s.id IS NULL THEN 'new' WHEN s.content_sha256 IS NOT DISTINCT FROM o.content_sha256 THEN 'same' ELSE 'changed' END AS state
  FROM {_STORED} s FULL JOIN {_OLDER} o ON s.post_id = o.post_id AND s.role = o.role""")
def document_states(spark: SparkSession, d: str) -> DataFrame:
    """The older versions delivered again on top of the current ones."""
    stored, older = _stored_and_older(spark, d)
    return versions.document_states(stored, older, AS_OF).select("post_id", "role", "state")


@query(f"""SELECT o.post_id, o.role, CASE WHEN s.id IS NULL THEN CASE WHEN o.content_sha256 IS NULL THEN 'error' ELSE 'new' END
  WHEN s.url IS NOT DISTINCT FROM o.url AND COALESCE(s.etag = o.etag, TRUE) AND COALESCE(s.http_last_modified = o.http_last_modified, TRUE) AND COALESCE(s.size_bytes = o.size_bytes, TRUE)
    AND ((s.etag IS NOT NULL AND o.etag IS NOT NULL) OR (s.http_last_modified IS NOT NULL AND o.http_last_modified IS NOT NULL) OR (s.size_bytes IS NOT NULL AND o.size_bytes IS NOT NULL)) THEN 'same'
  WHEN o.content_sha256 IS NULL THEN 'error' WHEN s.content_sha256 = o.content_sha256 THEN 'same' ELSE 'changed' END AS state
  FROM {_OLDER} o LEFT JOIN {_STORED} s ON s.post_id = o.post_id AND s.role = o.role""")
def reconcile_files(spark: SparkSession, d: str) -> DataFrame:
    stored, older = _stored_and_older(spark, d)
    return versions.reconcile(stored, older.withColumn("error", F.lit(None).cast("string"))).select("post_id", "role", "state")


@query(f"""SELECT post_id, COUNT(*) AS checked, 0::BIGINT AS new, COUNT(*) FILTER (WHERE state = 'changed') AS changed, COUNT(*) FILTER (WHERE state = 'same') AS same, 0::BIGINT AS errors FROM
  (SELECT post_id, CASE WHEN version > 1 THEN 'changed' ELSE 'same' END AS state FROM {_FILES} WHERE role IN
   ('Tender Item List', 'Terms & Conditions', 'Tender Preliminary Result', 'Tender Final Result', 'Additional Attachments', 'Objection to the Results')) GROUP BY post_id""")
def file_counts(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "attachments").dropDuplicates(["id"])
    return versions.file_counts(files.select("post_id", "role", F.when(F.col("version") > 1, "changed").otherwise("same").alias("state")))


@query(f"SELECT id FROM {_FILES} WHERE parse_status IS NULL OR parse_status IN ('pending', 'failed')")
def pending_files(spark: SparkSession, d: str) -> DataFrame:
    return sinks.pending(table(spark, d, "attachments").dropDuplicates(["id"])).select("id")


@query(f"SELECT id, CASE WHEN starts_with(local_path, 'archive/') THEN substr(local_path, 9) ELSE local_path END AS local_path FROM {_FILES}")
def relative_paths(spark: SparkSession, d: str) -> DataFrame:
    return versions.relative_paths(table(spark, d, "attachments").select("id", "local_path").dropDuplicates(["id"]), "archive")


@query(f"""SELECT id, CASE WHEN NULLIF(local_path, '') IS NOT NULL THEN 'stored' WHEN NULLIF(url, '') IS NOT NULL THEN 'redirect' ELSE 'missing' END AS action,
  COALESCE(NULLIF(local_path, ''), NULLIF(url, '')) AS target FROM {_FILES}""")
def document_lookup(spark: SparkSession, d: str) -> DataFrame:
    return tables.document_lookup(table(spark, d, "attachments").select("id", "local_path", "url").dropDuplicates(["id"]))


@query("""SELECT COALESCE(t.source, 'nupco') AS source, COUNT(*) AS tenders, COALESCE(SUM(i.n), 0)::BIGINT AS items, COALESCE(SUM(f.n), 0)::BIGINT AS files FROM tenders t
  LEFT JOIN (SELECT post_id, COUNT(DISTINCT id) AS n FROM tender_items GROUP BY 1) i USING (post_id) LEFT JOIN (SELECT post_id, COUNT(DISTINCT id) AS n FROM attachments GROUP BY 1) f USING (post_id) GROUP BY 1""")
def source_totals(spark: SparkSession, d: str) -> DataFrame:
    return marts.source_totals(*_some(spark, d, "tenders", "tender_items", "attachments"))


@query("SELECT post_id, COUNT(*) AS changes FROM tender_history WHERE field = 'status_label' AND run_id >= 50 GROUP BY post_id")
def bound_sql(spark: SparkSession, d: str) -> DataFrame:
    table(spark, d, "tender_history").createOrReplaceTempView("history_rows")
    return tables.run_sql(spark, "SELECT post_id, COUNT(*) AS changes FROM history_rows WHERE field = :field AND run_id >= :run GROUP BY post_id", field="status_label", run=50)


def _form_sql(c: str) -> str:
    """A value as in web forms: DuckDB's escapes, with the three characters that forms write otherwise."""
    return f"replace(replace(replace(url_encode(COALESCE({c}, '')), '%20', '+'), '%2A', '*'), '~', '%7E')"


@query(f"""SELECT post_id, 'https://p.example/d?tendNo=' || {_form_sql("tender_id")} || '&method=' || {_form_sql("method")} || '&buyer=' || {_form_sql("buyer")} AS link,
  COALESCE(NULLIF(title_en, ''), NULLIF(title_ar, '')) AS title FROM tenders""")
def detail_links(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    link = X.detail_url("https://p.example/d", tendNo=c("tender_id"), method=c("method"), buyer=c("buyer"))
    return table(spark, d, "tenders").select("post_id", link.alias("link"), X.shown_title(c("title_en"), c("title_ar")).alias("title"))


# --- upsert, delist ---

_STAND = """(SELECT *, snapshot_no {shift} AS delivery FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_no, post_id ORDER BY CAST(last_seen_at AS TIMESTAMPTZ) DESC NULLS LAST, content_hash DESC NULLS LAST) AS k
  FROM tender_snapshots WHERE post_id IS NOT NULL) WHERE k = 1 AND snapshot_no {which})"""
_BOTH = f"{_STAND.format(shift='+ 1', which='<= 5')} a FULL JOIN {_STAND.format(shift='+ 0', which='>= 2')} b ON a.post_id = b.post_id AND a.delivery = b.delivery"


def _upserted(spark: SparkSession, d: str) -> DataFrame:
    """Every snapshot delivered on top of the one before it; the key is the number of the delivery and the tender."""
    columns = ("content_hash", "tender_id", "source", "status_label", "is_listed", "last_seen_at")
    rows = standing_rows(table(spark, d, "tender_snapshots"), states=columns).where(F.col("post_id").isNotNull())
    number = F.col("snapshot_no")
    keyed = lambda df, n: df.withColumn("key", F.concat_ws(":", n.cast("string"), F.col("post_id").cast("string"))).drop("snapshot_no", "post_id")
    stamps = {c: F.lit("2026-07-20") for c in ("first_seen_at", "last_changed_at")}
    stored, new = keyed(rows.where(number <= 5), number + 1).withColumns(stamps), keyed(rows.where(number >= 2), number)
    return upsert.upsert(stored, new, AS_OF, 4, key="key", tracked=("tender_id", "status_label"))


def _by_delivery(df: DataFrame, *columns: str) -> DataFrame:
    part = F.split("key", ":")
    return df.select(part[0].cast("int").alias("delivery"), part[1].cast("long").alias("post_id"), *columns)


_STATE = """CASE WHEN a.post_id IS NULL THEN 'new' WHEN b.post_id IS NULL THEN 'kept' WHEN COALESCE(TRIM(a.status_label), '') <> COALESCE(TRIM(b.status_label), '')
  OR COALESCE(TRIM(a.tender_id), '') <> COALESCE(TRIM(b.tender_id), '') OR a.is_listed IS DISTINCT FROM b.is_listed THEN 'changed' ELSE 'same' END"""


@query(f"SELECT COALESCE(a.delivery, b.delivery) AS delivery, COALESCE(a.post_id, b.post_id) AS post_id, {_STATE} AS state FROM {_BOTH}")
def upsert_states(spark: SparkSession, d: str) -> DataFrame:
    return _by_delivery(_upserted(spark, d), "state")


@query(f"""WITH p AS (SELECT COALESCE(a.delivery, b.delivery) AS delivery, COALESCE(a.post_id, b.post_id) AS post_id, a.post_id AS o, b.post_id AS n, a.status_label AS s0, b.status_label AS s1, a.tender_id AS t0, b.tender_id AS t1, a.is_listed AS l0, b.is_listed AS l1
    FROM {_BOTH})
  SELECT delivery, post_id, '_record' AS field, NULL AS old_value, t1 AS new_value, 'new' AS change_kind FROM p WHERE o IS NULL
  UNION ALL SELECT delivery, post_id, 'status_label', s0, s1, 'update' FROM p WHERE o IS NOT NULL AND n IS NOT NULL AND COALESCE(TRIM(s0), '') <> COALESCE(TRIM(s1), '')
  UNION ALL SELECT delivery, post_id, 'tender_id', t0, t1, 'update' FROM p WHERE o IS NOT NULL AND n IS NOT NULL AND COALESCE(TRIM(t0), '') <> COALESCE(TRIM(t1), '')
  UNION ALL SELECT delivery, post_id, 'is_listed', l0::VARCHAR, l1::VARCHAR, CASE WHEN COALESCE(l1, 0) <> 0 THEN 'relist' ELSE 'delist' END FROM p WHERE o IS NOT NULL AND n IS NOT NULL AND l0 IS DISTINCT FROM l1""")
def upsert_history(spark: SparkSession, d: str) -> DataFrame:
    return _by_delivery(upsert.history_rows(_upserted(spark, d), "key"), "field", "old_value", "new_value", "change_kind")


@query(f"""SELECT t.post_id, t.tender_id, 'delist' AS change_kind FROM tenders t WHERE t.source = 'nupco' AND t.is_listed = 1
  AND t.post_id NOT IN (SELECT post_id FROM tender_snapshots WHERE snapshot_no = 6 AND post_id IS NOT NULL)""")
def delist(spark: SparkSession, d: str) -> DataFrame:
    tenders, snaps = _some(spark, d, "tenders", "tender_snapshots")
    return upsert.delist_unseen(tenders, snaps.where(F.col("snapshot_no") == 6), "nupco", AS_OF, 7, complete=True)[1].select("post_id", "tender_id", "change_kind")


# --- discovery ---

_URLKEY = "lower(regexp_replace(url_decode(replace({c}, '+', '%2B')), '/+$', ''))"


@query(f"""WITH g AS (SELECT {_URLKEY.format(c='url')} AS url_key, MIN(post_id) AS post_id FROM tenders WHERE url IS NOT NULL AND discovered_via LIKE 'grid%' GROUP BY 1),
  s AS (SELECT {_URLKEY.format(c='url')} AS url_key, MIN(url) AS url FROM tenders WHERE url IS NOT NULL AND discovered_via LIKE '%sitemap' GROUP BY 1)
  SELECT COALESCE(g.url_key, s.url_key) AS url_key, g.post_id, CASE WHEN s.url_key IS NULL THEN 'grid' WHEN g.url_key IS NULL THEN 'sitemap' ELSE 'both' END AS via
  FROM g FULL JOIN s ON g.url_key = s.url_key""")
def discovery_union(spark: SparkSession, d: str) -> DataFrame:
    tenders = table(spark, d, "tenders")
    cards = tenders.where(F.col("discovered_via").startswith("grid"))
    site = tenders.where(F.col("discovered_via").endswith("sitemap")).select("url", F.col("sitemap_lastmod").alias("lastmod"))
    return discovery.found_tenders(cards, site).select("url_key", "post_id", "via")


@query("""SELECT post_id, CASE WHEN list_contains(s, 'Final_Awarded') THEN 'Final_Awarded' WHEN list_contains(s, 'EP0034') THEN 'EP0034' WHEN list_contains(s, 'EP0035') THEN 'EP0035'
  WHEN list_contains(s, 'Initial_Awarded') THEN 'Initial_Awarded' WHEN list_contains(s, 'EP0854') THEN 'EP0854' WHEN list_contains(s, 'EP0561') THEN 'EP0561'
  WHEN list_contains(s, 'EP0560') THEN 'EP0560' WHEN list_contains(s, 'Opened') THEN 'Opened' END AS status,
  COALESCE(CAST(list_has_any(s, ['final-results', 'cancelled']) AS INTEGER), 0) AS is_terminal FROM (SELECT post_id, TRY_CAST(TRY_CAST(status_slugs AS JSON) AS VARCHAR[]) AS s FROM tenders)""")
def label_precedence(spark: SparkSession, d: str) -> DataFrame:
    slugs = F.from_json("status_slugs", "array<string>")
    return table(spark, d, "tenders").select("post_id", discovery.first_of(slugs, discovery.PRECEDENCE).alias("status"), discovery.is_terminal(slugs).alias("is_terminal"))


@query("""SELECT post_id, MIN(snapshot_no) AS year, COUNT(DISTINCT status_label) AS labels, (SELECT MIN(source) FROM tender_snapshots s WHERE s.post_id = t.post_id AND s.source IS NOT NULL) AS subcategory
  FROM tender_snapshots t WHERE post_id IS NOT NULL AND snapshot_no <> 5 GROUP BY post_id""")
def merged_passes(spark: SparkSession, d: str) -> DataFrame:
    """The snapshots as yearly crawls, of which the fifth failed."""
    passes = table(spark, d, "tender_snapshots").select(
        "post_id", F.col("snapshot_no").alias("year"), F.lit(1).alias("pass_no"), (F.col("snapshot_no") != 5).alias("ok"), F.col("status_label").alias("label"), F.col("source").alias("subcategory"),
        F.lit(None).cast("string").alias("title"),
    )
    return discovery.merged_passes(passes).select("post_id", "year", F.size("labels").cast("long").alias("labels"), "subcategory")


@query("SELECT post_id, is_terminal, tender_year FROM tenders ORDER BY is_terminal DESC NULLS LAST, tender_year DESC NULLS LAST, post_id DESC LIMIT 100")
def work_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tenders").select("post_id", "is_terminal", "tender_year", F.col("is_terminal").alias("awarded"), F.col("tender_year").alias("year"))
    return discovery.work_order(rows, 100).select("post_id", "is_terminal", "tender_year")


@query(f"""SELECT post_id, detail_fetched_at IS NULL OR COALESCE(is_terminal, 0) = 0 OR sitemap_lastmod IS DISTINCT FROM '{AS_OF}' AS needed FROM tenders""")
def fetch_needed(spark: SparkSession, d: str) -> DataFrame:
    known = {c: F.col(c) for c in ("post_id", "detail_fetched_at", "is_terminal")} | {"lastmod": F.col("sitemap_lastmod")}
    return table(spark, d, "tenders").select("post_id", discovery.needs_fetch(known, {"lastmod": F.lit(AS_OF)}).alias("needed"))


# --- search ---


def _bm25(rows: str, key: str, text: str, tokens: list[str], limit: int | None = None) -> str:
    tf = ", ".join(f"len(list_filter(w, lambda x: starts_with(x, '{t}'))) AS tf{i}" for i, t in enumerate(tokens))
    df = ", ".join(f"COUNT(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i, _ in enumerate(tokens))
    score = " + ".join(f"ln(1 + (n - df{i} + 0.5) / (df{i} + 0.5)) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * dl / avgdl))" for i, _ in enumerate(tokens))
    every = " AND ".join(f"tf{i} > 0" for i, _ in enumerate(tokens))
    end = f" ORDER BY score DESC, {key} LIMIT {limit}" if limit else ""
    return f"""WITH w AS (SELECT {key}, regexp_extract_all(lower(COALESCE({text}, '')), '[\\p{{L}}\\p{{M}}\\p{{N}}_]+') AS w FROM {rows} WHERE {key} IS NOT NULL),
  h AS (SELECT {key}, len(w) AS dl, {tf} FROM w), s AS (SELECT COUNT(*) AS n, AVG(dl) AS avgdl, {df} FROM h)
  SELECT {key}, ROUND({score}, 6) AS score FROM h, s WHERE {every}{end}"""


@query(_bm25("(SELECT DISTINCT id, description, nupco_code, tender_id, generic_name FROM tender_items)", "id", "concat_ws(' ', description, nupco_code, tender_id, generic_name)", ["mg", "cap"]))
def item_search(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "tender_items").select("id", "description", "nupco_code", "tender_id", "generic_name").dropDuplicates(["id"])
    found = search.search(items, "id", F.concat_ws(" ", "description", "nupco_code", "tender_id", "generic_name"), "MG cap*")
    return found.select("id", F.round("score", 6).alias("score"))


@query(_bm25("tenders", "post_id", "concat_ws(' ', title_en, title_ar, tender_id)", ["supply", "med"], 50))
def tender_search(spark: SparkSession, d: str) -> DataFrame:
    found = search.search(table(spark, d, "tenders"), "post_id", F.concat_ws(" ", "title_en", "title_ar", "tender_id"), '"supply" -- med*;')
    return found.select("post_id", F.round("score", 6).alias("score")).orderBy(F.desc("score"), "post_id").limit(50)


@query(_bm25("documents", "doc_id", "text", ["warranty", "deliver"]))
def document_search(spark: SparkSession, d: str) -> DataFrame:
    found = search.search(table(spark, d, "documents"), "doc_id", F.col("text"), "warranty deliver")
    return found.select("doc_id", F.round("score", 6).alias("score"))


_ITEM_TEXT = ("description", "nupco_code", "item_no", "tender_id", "generic_name", "generic_name_ar", "rdl_code")
_ITEM_SCORES = _bm25(f"(SELECT DISTINCT id, {', '.join(_ITEM_TEXT)} FROM tender_items)", "id", f"concat_ws(' ', {', '.join(_ITEM_TEXT)})", ["mg", "cap"])
_FOUND_ITEMS = f"(SELECT c.*, s.score FROM {_CURRENT} c JOIN ({_ITEM_SCORES}) s ON s.id = c.id WHERE c.category_guess = 'pharma' AND c.is_accessory = 0 AND {_OPEN})"


def _item_page(spark: SparkSession, d: str, sort: str) -> DataFrame:
    items = table(spark, d, "tender_items").select("id", *_ITEM_TEXT).dropDuplicates(["id"])
    scores = search.search(items, "id", F.concat_ws(" ", *_ITEM_TEXT), "MG cap*")
    found = marts.search_page(_current(spark, d), scores, "id", sort, 100, 5, then=marts.SORTS["opening_desc"], category="pharma", open_only=True, hide_accessories=True)
    return found.select("id", "score", "submission_ts", "total")


@query(f"SELECT id, score, submission_ts, (SELECT COUNT(*) FROM {_FOUND_ITEMS}) AS total FROM {_FOUND_ITEMS} ORDER BY score DESC, opening_ts DESC NULLS LAST, id LIMIT 100 OFFSET 5")
def item_search_page(spark: SparkSession, d: str) -> DataFrame:
    """Words, filters, order by relevance and the total in one query, over all seven fields of an item."""
    return _item_page(spark, d, "relevance")


@query(f"SELECT id, score, submission_ts, (SELECT COUNT(*) FROM {_FOUND_ITEMS}) AS total FROM {_FOUND_ITEMS} ORDER BY submission_ts NULLS LAST, id LIMIT 100 OFFSET 5")
def item_search_by_deadline(spark: SparkSession, d: str) -> DataFrame:
    return _item_page(spark, d, "deadline_asc")


_FOUND_TENDERS = f"""(SELECT t.post_id, s.score, t.opening_ts FROM tenders t JOIN ({_bm25("tenders", "post_id", "concat_ws(' ', title_en, title_ar, tender_id)", ["s"])}) s ON s.post_id = t.post_id
  WHERE COALESCE(t.country, 'SA') = 'SA' AND t.status_label = 'Cancelled')"""


@query(f"SELECT post_id, score, (SELECT COUNT(*) FROM {_FOUND_TENDERS}) AS total FROM {_FOUND_TENDERS} ORDER BY score DESC, post_id LIMIT 50")
def tender_search_page(spark: SparkSession, d: str) -> DataFrame:
    tenders = table(spark, d, "tenders")
    scores = search.search(tenders, "post_id", F.concat_ws(" ", "title_en", "title_ar", "tender_id"), "s")
    return marts.search_page(tenders, scores, "post_id", status="Cancelled", country="sa").select("post_id", "score", "total")


@query("SELECT w AS term, post_id, COUNT(*)::INTEGER AS tf FROM (SELECT post_id, unnest(regexp_extract_all(lower(concat_ws(' ', title_en, title_ar)), '[\\p{L}\\p{M}\\p{N}_]+')) AS w FROM tenders) GROUP BY 1, 2")
def title_postings(spark: SparkSession, d: str) -> DataFrame:
    return search.postings(table(spark, d, "tenders"), "post_id", F.concat_ws(" ", "title_en", "title_ar")).select("term", "post_id", "tf")


# --- scalars ---


def _category_sql(text: str) -> str:
    cases = " ".join(f"WHEN regexp_matches({text}, '{classify.category_pattern(c)}') THEN '{c}'" for c in classify.STEMS)
    return f"CASE {cases} ELSE 'other' END"


@query("SELECT post_id, " + _category_sql("lower(concat_ws(' ', title_en, title_ar))") + " AS category FROM tenders")
def tender_categories(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tenders").select("post_id", classify.word_category(F.col("title_en"), F.col("title_ar")).alias("category"))


_GROUP = "CASE WHEN length(regexp_replace(nupco_code, '[^0-9]', '', 'g')) >= 10 THEN substr(regexp_replace(nupco_code, '[^0-9]', '', 'g'), 1, 2) END"
_OF_GROUP = "CASE g " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in classify.GROUPS.items()) + " END"


@query(f"""SELECT id, g AS code_group, CASE WHEN w = 'service' OR c IS NULL OR (c = 'device' AND w IN ('dental', 'pharma')) OR (c = 'lab' AND w = 'dental') THEN w ELSE c END AS category,
  COALESCE(CAST(regexp_matches(lower(description), '{"|".join(classify.ACCESSORY)}') AS INTEGER), 0) AS is_accessory
  FROM (SELECT *, {_OF_GROUP} AS c FROM (SELECT id, description, {_GROUP} AS g, {_category_sql("lower(COALESCE(description, ''))")} AS w FROM {_ITEMS}))""")
def classified_items(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tender_items").select("id", "nupco_code", "description").dropDuplicates(["id"])
    return rows.select("id", X.code_group(F.col("nupco_code")).alias("code_group"), classify.item_category(F.col("nupco_code"), F.col("description")).alias("category"), classify.accessory(F.col("description")).alias("is_accessory"))


_ID = r"^\s*([A-Z]{2,4})([0-9]+)[-/]([0-9]{2,4})"


@query(f"""SELECT post_id, NULLIF(regexp_extract(tender_id, '{_ID}', 1), '') AS kind, TRY_CAST(NULLIF(regexp_extract(tender_id, '{_ID}', 2), '') AS INTEGER) AS seq,
  CASE WHEN y > 100 THEN y ELSE y + 2000 END AS year FROM (SELECT *, TRY_CAST(NULLIF(regexp_extract(tender_id, '{_ID}', 3), '') AS INTEGER) AS y FROM tenders)""")
def tender_id_parts(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("tender_id")
    return table(spark, d, "tenders").select("post_id", X.tender_kind(t).alias("kind"), X.tender_seq(t).alias("seq"), X.tender_year(t).alias("year"))


_ARABIC = "translate({c}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')"
_DMY = "([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})"


def _dmy_sql(c: str) -> tuple[str, str]:
    t = _ARABIC.format(c=c)
    y, m, dd = (f"regexp_extract({t}, '{_DMY}', {i})" for i in (3, 2, 1))
    loose = f"CASE WHEN regexp_matches({t}, '{_DMY}') THEN {y} || '-' || lpad({m}, 2, '0') || '-' || lpad({dd}, 2, '0') END"
    return f"CAST(TRY_CAST({loose} AS DATE) AS VARCHAR)", loose


@query("SELECT post_id, " + ", ".join(f"{s} AS {n}" for c, a, b in (("opening_date", "opening", "opening_loose"), ("submission_deadline", "deadline", "deadline_loose")) for s, n in zip(_dmy_sql(c), (a, b))) + " FROM tenders")
def date_clean(spark: SparkSession, d: str) -> DataFrame:
    cols = [f(F.col(c)).alias(n) for c, a, b in (("opening_date", "opening", "opening_loose"), ("submission_deadline", "deadline", "deadline_loose")) for f, n in ((X.dmy_iso, a), (X.dmy_iso_unchecked, b))]
    return table(spark, d, "tenders").select("post_id", *cols)


@query(f"""SELECT id, TRY_CAST(NULLIF(regexp_replace({_ARABIC.format(c='qty_raw')}, '[^0-9.]', '', 'g'), '') AS DOUBLE) AS digits,
  TRY_CAST(replace(NULLIF(regexp_extract(translate({_ARABIC.format(c='qty_raw')}, '٫', '.'), '-?[0-9,]*\\.?[0-9]+', 0), ''), ',', '') AS DOUBLE) AS first_number FROM {_ITEMS}""")
def number_clean(spark: SparkSession, d: str) -> DataFrame:
    q = F.col("qty_raw")
    return table(spark, d, "tender_items").select("id", "qty_raw").dropDuplicates(["id"]).select("id", X.digits_number(q).alias("digits"), X.first_number(q).alias("first_number"))


@query(f"""SELECT id, NULLIF(trim(regexp_replace(description, '[\\s\\p{{Z}}]+', ' ', 'g')), '') AS description, NULLIF(regexp_replace(rdl_code, '[\\s-]', '', 'g'), '') AS rdl_code,
  NULLIF(regexp_replace(nupco_code, '[^0-9]', '', 'g'), '') AS nupco_code, COALESCE(replace(substr(COALESCE(NULLIF(uom, ''), '—'), 1, 70), '|', '\\|')) AS cell FROM {_ITEMS}""")
def text_clean(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tender_items").select("id", "description", "rdl_code", "nupco_code", "uom").dropDuplicates(["id"])
    return rows.select("id", X.clean_text(F.col("description")).alias("description"), X.drug_code(F.col("rdl_code")).alias("rdl_code"), X.only_digits(F.col("nupco_code")).alias("nupco_code"), X.table_cell(F.col("uom")).alias("cell"))


@query("""SELECT id, NULLIF(split_part(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[a-zA-Z]+://[^/]*', ''), '/', -1), '') AS file,
  NULLIF(lower(regexp_extract(filename, '[^.]\\.([A-Za-z0-9]+)$', 1)), '') AS extension, lower(regexp_replace(url_decode(replace(url, '+', '%2B')), '/+$', '')) AS url_key FROM (SELECT DISTINCT * FROM attachments)""")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "attachments").select("id", "url", "filename").dropDuplicates(["id"])
    return rows.select("id", X.url_file(F.col("url")).alias("file"), X.file_extension(F.col("filename")).alias("extension"), X.url_key(F.col("url")).alias("url_key"))


@query("SELECT doc_id, sha256(text) AS digest FROM documents")
def content_hash(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", X.content_hash(F.col("text")).alias("digest"))


@query("""SELECT post_id, sha256('{"listed":' || COALESCE(is_listed::VARCHAR, 'null') || ',"post":' || post_id || ',"status":' || COALESCE(to_json(status_label)::VARCHAR, 'null') || ',"title":' || COALESCE(to_json(title_ar)::VARCHAR, 'null') || '}') AS digest FROM tenders""")
def record_hash(spark: SparkSession, d: str) -> DataFrame:
    """A digest of each record that no order of its fields changes."""
    c = F.col
    return table(spark, d, "tenders").select("post_id", X.canonical_json_hash(title=c("title_ar"), status=c("status_label"), post=c("post_id"), listed=c("is_listed")).alias("digest"))


@query("SELECT doc_id, n_chars, length(text) AS found, length(text) = n_chars AS ok FROM documents")
def length_audit(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "n_chars", F.length("text").cast("long").alias("found"), (F.length("text") == F.col("n_chars")).alias("ok"))


@query("""SELECT post_id, list_transform(list_filter(string_split(status_label, ','), lambda p: trim(p) <> ''), lambda p: regexp_replace(regexp_replace(lower(trim(p)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'))[1] AS slug,
  CASE WHEN days_to_deadline < 0 THEN 'closed ' || (-days_to_deadline)::VARCHAR || 'd ago' WHEN days_to_deadline = 0 THEN 'closes today' WHEN days_to_deadline > 0 THEN days_to_deadline::VARCHAR || 'd left' END AS label,
  datediff('day', DATE '2026-09-01', TRY_CAST(submission_ts AS DATE))::INTEGER AS days FROM tenders""")
def deadline_labels(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "tenders").select(
        "post_id", F.get(X.status_slugs(c("status_label")), F.lit(0)).alias("slug"), X.deadline_label(c("days_to_deadline")).alias("label"), X.days_left(c("submission_ts").try_cast("date"), AS_OF).alias("days"),
    )


@query("""SELECT post_id, CASE WHEN s = 'Final_Awarded' THEN 'Awarded' WHEN s = 'EP0034' THEN 'Cancelled' WHEN s = 'Opened' THEN 'Bids opened' WHEN submission_ts >= '2026-09-01' THEN 'Open' ELSE 'Closed' END AS status_label,
  CAST(COALESCE(s IN ('Final_Awarded', 'EP0034'), FALSE) AS INTEGER) AS is_terminal FROM
  (SELECT *, CASE WHEN contains(status_slugs, '"Final_Awarded"') THEN 'Final_Awarded' WHEN contains(status_slugs, '"EP0034"') THEN 'EP0034' WHEN contains(status_slugs, '"Opened"') THEN 'Opened' END AS s FROM tenders)""")
def labelled_tenders(spark: SparkSession, d: str) -> DataFrame:
    slugs = F.from_json("status_slugs", "array<string>")
    rows = table(spark, d, "tenders").select("post_id", discovery.first_of(slugs, ("Final_Awarded", "EP0034", "Opened")).alias("status"), F.col("submission_ts").alias("deadline"))
    return discovery.labelled(rows, AS_OF).select("post_id", "status_label", "is_terminal")


@query("""SELECT post_id, CASE WHEN regexp_matches(tender_id, '^[0-9]+-[0-9]+$') THEN 1000000000000 + split_part(tender_id, '-', 1)::BIGINT * 100 + split_part(tender_id, '-', 2)::BIGINT END AS made FROM tenders WHERE source = 'joneps'""")
def portal_keys(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "tenders").where(F.col("source") == "joneps")
    part = lambda i: F.regexp_extract("tender_id", r"^([0-9]+)-([0-9]+)$", i)
    return rows.select("post_id", F.when(F.col("tender_id").rlike(r"^[0-9]+-[0-9]+$"), X.portal_key(X.none_if_empty(part(1)), part(2))).alias("made"))


# --- nested and rendered pages, read back ---


@query("""SELECT id, (k - 1)::INTEGER AS position, e.entity, e.abbr, e.qty FROM (SELECT id, unnest(d) AS e, generate_subscripts(d, 1) AS k FROM
  (SELECT DISTINCT id, TRY_CAST(TRY_CAST(demand_json AS JSON) AS STRUCT(entity VARCHAR, abbr VARCHAR, qty DOUBLE)[]) AS d FROM tender_items))""")
def demand_lines(spark: SparkSession, d: str) -> DataFrame:
    return portal_json.demand_rows(table(spark, d, "tender_items").select("id", "demand_json").dropDuplicates(["id"]))


@query(f"""SELECT id, NULLIF(regexp_replace(rdl_code, '[\\s-]', '', 'g'), '') AS rdl_code, NULLIF(trim(unspsc), '') AS unspsc, NULLIF(description, '') AS description, uom, qty FROM {_ITEMS} WHERE id IS NOT NULL""")
def drug_lines(spark: SparkSession, d: str) -> DataFrame:
    """Items written as the second portal's JSON, then read."""
    items = table(spark, d, "tender_items").select("id", "description", "generic_name", "rdl_code", "unspsc", "uom", "qty").dropDuplicates(["id"])
    line = F.struct(F.col("unspsc").alias("clId"), F.col("generic_name").alias("clNmEn"), F.col("rdl_code").alias("rdlItemCd"), F.col("description").alias("rdlGenerNm"), F.col("uom").alias("unitMesurNm"), F.col("qty").alias("totlQty"))
    payloads = items.select("id", F.to_json(F.struct(F.lit(1).alias("total"), F.array(line).alias("list"))).alias("payload"), F.coalesce(X.none_if_empty(F.col("description")), X.none_if_empty(F.col("generic_name"))).isNull().alias("bare"), F.col("description").alias("d0"))
    read = portal_json.drug_lines(payloads, "id")
    return read.join(payloads.select("id", "d0"), "id").select("id", "rdl_code", "unspsc", X.none_if_empty(F.col("d0")).alias("description"), "uom", "qty")


_FLAT = "trim(regexp_replace(COALESCE({c}, ''), '[\\s\\p{{Z}}]+', ' ', 'g'))"
_PORTAL_NO = "CASE WHEN regexp_matches(tender_id, '^[0-9]+-[0-9]+$') THEN split_part(tender_id, '-', {i}) ELSE CAST(post_id AS VARCHAR) END"


@query(f"""SELECT post_id, {_PORTAL_NO.format(i=1)} AS tend_no, {_PORTAL_NO.format(i=2)} AS tend_seq, {_FLAT.format(c='title_en')} AS title, {_FLAT.format(c='buyer')} AS buyer, {_dmy_sql("opening_date")[1]} AS published,
  {_dmy_sql("submission_deadline")[1]} AS deadline, (post_id % 90000)::INTEGER AS results FROM tenders""")
def list_pages(spark: SparkSession, d: str) -> DataFrame:
    """All tenders written as result lists, with the number of results grouped by dots, then read."""
    t, text = table(spark, d, "tenders"), F.lit
    paired = F.col("tender_id").rlike(r"^[0-9]+-[0-9]+\z")
    number = lambda i: F.when(paired, F.regexp_extract("tender_id", "^([0-9]+)-([0-9]+)", i)).otherwise(F.col("post_id").cast("string"))
    call = F.concat(text("<td class='l'><a href='#' onclick=\"fn_goDetail('"), number(1), text("', '"), number(2), text("', '1', 'EP1313', 'B', '7', 'EP0021', 'EP0016');\">"), number(1), text("</a></td>"))
    empty = lambda c: F.coalesce(F.col(c), text(""))
    rest = [F.concat(text("<td>"), x, text("</td>")) for x in (empty("title_en"), empty("buyer"), text("Medicines"), empty("opening_date"), empty("submission_deadline"))]
    dotted = F.regexp_replace(F.format_number(F.pmod("post_id", text(90_000)), 0), ",", ".")
    html = F.concat(text("<p>عدد <span class='pointTxt2'> "), dotted, text(" </span> النتائج</p><table><tr><th>No</th><th>Title</th></tr><tr class='r'>"), call, *rest, text("</tr></table>"))
    pages = t.select("post_id", html.alias("html"))
    rows = portal_html.list_rows(pages, "post_id").join(pages.select("post_id", portal_html.list_total(F.col("html")).alias("results")), "post_id")
    return rows.select("post_id", "tend_no", "tend_seq", "title", "buyer", "published", "deadline", "results")


@query("SELECT DISTINCT trim(url) AS url, sitemap_lastmod AS lastmod FROM tenders WHERE contains(url, '/tender/')")
def sitemap_entries(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "tenders").where(F.col("url").isNotNull())
    lastmod = F.coalesce(F.concat(F.lit("<lastmod>"), F.col("sitemap_lastmod"), F.lit("</lastmod>\n")), F.lit(""))
    xml = F.concat(F.lit("<?xml version='1.0'?><urlset>\n<url>\n<loc>"), F.col("url"), F.lit("</loc>\n"), lastmod, F.lit("<priority>0.5</priority></url></urlset>"))
    return portal_html.sitemap_urls(t.select(xml.alias("html"))).distinct()


_SLUGS = "COALESCE(list_filter(TRY_CAST(TRY_CAST(status_slugs AS JSON) AS VARCHAR[]), lambda x: regexp_matches(x, '^[a-z0-9-]+$')), [])"


@query(f"SELECT post_id, array_to_string({_SLUGS}, ',') AS slugs, NULLIF(url, '') AS url, NULLIF({_FLAT.format(c='title_en')}, '') AS title, NULLIF({_FLAT.format(c='submission_deadline')}, '') AS deadline FROM tenders")
def card_pages(spark: SparkSession, d: str) -> DataFrame:
    """All tenders written as cards of a result grid, then read."""
    t, text = table(spark, d, "tenders"), F.lit
    classes = F.array_join(F.transform(F.filter(F.coalesce(F.from_json("status_slugs", "array<string>"), F.array().cast("array<string>")), lambda x: x.rlike(r"^[a-z0-9-]+\z")), lambda x: F.concat(text(" tender-status-"), x)), "")
    shown = lambda widget, c: F.concat(text(f"<div class='w' data-id=\"{widget}\" data-w='1'><span>"), F.coalesce(F.col(c), text("")), text("</span></div>"))
    card = F.concat(
        text("<div class=\"e-loop-item post-"), F.col("post_id").cast("string"), text(" type-tender"), classes, text("\" data-x='1'><a class='c' href=\""), F.coalesce("url", text("")), text("\">open</a>"),
        shown("aa11", "title_en"), shown("bb22", "submission_deadline"), text("</div>"),
    )
    html = F.concat(text("<div id='tender-grid'>"), card, text("<div class=\"e-loop-item none\"></div></div>"))
    rows = portal_html.cards(t.select("post_id", html.alias("html")).withColumnRenamed("post_id", "page_id"), {"title": "aa11", "deadline": "bb22"})
    return rows.select("post_id", F.array_join("status_slugs", ",").alias("slugs"), "url", "title", "deadline")


@query(f"""SELECT post_id, NULLIF(h, '') AS opening_date, NULLIF(s, '') AS submission_deadline, NULLIF(t, '') AS tender_id, NULLIF(l, '') AS status_label, booklet_price_sar, CASE WHEN url <> '' THEN url END AS terms_url FROM
  (SELECT *, {_FLAT.format(c='opening_date')} AS h, {_FLAT.format(c='submission_deadline')} AS s, {_FLAT.format(c='tender_id')} AS t, {_FLAT.format(c='status_label')} AS l FROM tenders)""")
def detail_pages(spark: SparkSession, d: str) -> DataFrame:
    """All tenders written as detail pages of headings and buttons, then read."""
    t, text = table(spark, d, "tenders"), F.lit
    heading = lambda x: F.concat(text("<div class='e' data-widget_type=\"heading.default\"><h2>"), F.coalesce(x, text("")), text("</h2></div>"))
    price = F.when(F.col("booklet_price_sar").isNotNull(), F.concat(F.format_string("%.2f", "booklet_price_sar"), text(" SAR")))
    html = F.concat(
        text("<html lang=\"en-US\"><body class=\"single postid-"), F.col("post_id").cast("string"), text(" logged\">"), heading(text("Tender ID :")), heading(F.col("tender_id")), heading(F.col("status_label")), heading(text("Opening Date")), heading(F.col("opening_date")),
        heading(text("Submission Deadline:")), heading(F.col("submission_deadline")), heading(text("Tender Booklet Price")), heading(price),
        text("<a class=\"elementor-button x\" href=\""), F.coalesce("url", text("")), text("\"><span>Terms</span></a></body></html>"),
    )
    rows = portal_html.details(t.select(F.col("post_id").alias("page_id"), html.alias("html")))
    return rows.select("post_id", "opening_date", "submission_deadline", "tender_id", "status_label", "booklet_price_sar", F.col("attachments")["Terms"].alias("terms_url"))


@query("""SELECT post_id, CAST(tender_year AS VARCHAR) AS code, NULLIF(trim(buyer), '') AS name, CAST(tender_seq AS VARCHAR) AS bracketed, CAST(days_to_deadline AS VARCHAR) AS progress FROM tenders""")
def entity_parts(spark: SparkSession, d: str) -> DataFrame:
    """Coded names, bracketed texts and the progress in a run's notes, taken apart."""
    c, text = F.col, F.lit
    entity = F.concat(F.coalesce(F.concat(text(" ["), c("tender_year").cast("string"), text("] ")), text("")), F.coalesce("buyer", text("")))
    price = F.concat(text("[] 12.5 [ "), c("tender_seq").cast("string"), text(" ]"))
    notes = F.to_json(F.struct(text("crawl").alias("mode"), c("days_to_deadline").alias("progress")))
    return table(spark, d, "tenders").select("post_id", X.entity_code(entity).alias("code"), X.entity_name(entity).alias("name"), X.bracketed(price).alias("bracketed"), X.progress(notes).alias("progress"))


@query("""SELECT post_id, COALESCE(NULLIF(title_en, ''), title_ar) AS title, detail_fetched_at IS NOT NULL AND COALESCE(is_listed, 0) = 1 AND (NOT COALESCE(is_terminal, 0) = 1 OR COALESCE(status_label, '') = 'Awarded') AS skipped FROM tenders""")
def merged_details(spark: SparkSession, d: str) -> DataFrame:
    """What a card says before what the detail page says, and which tenders need no reading."""
    c = F.col
    skipped = discovery.frozen(False, c("detail_fetched_at"), F.coalesce(c("is_listed"), F.lit(0)) == 1, F.coalesce(c("is_terminal"), F.lit(0)) == 1, F.coalesce(c("status_label"), F.lit("")) == "Awarded")
    return table(spark, d, "tenders").select("post_id", discovery.overlay({"title": c("title_en")}, {"title": c("title_ar")})["title"].alias("title"), skipped.alias("skipped"))


@query(f"""SELECT id, CASE WHEN parse_status = 'failed' THEN 'missing' WHEN size_bytes <> length(filename) THEN 'wrong size' WHEN lower(content_sha256) <> sha256(filename) THEN 'wrong hash' ELSE 'ok' END AS verdict
  FROM {_FILES} WHERE local_path IS NOT NULL AND filename IS NOT NULL""")
def archive_audit(spark: SparkSession, d: str) -> DataFrame:
    """The files against an archive that holds their names as contents; those whose parsing failed are missing in it."""
    files = table(spark, d, "attachments").dropDuplicates(["id"]).where(F.col("local_path").isNotNull() & F.col("filename").isNotNull())
    own = files.withColumn("local_path", F.concat_ws("#", "local_path", "id"))
    there = own.where(F.coalesce(F.col("parse_status") != "failed", F.lit(True)))
    archive = there.select(F.col("local_path").alias("path"), F.length("filename").cast("long").alias("length"), F.encode("filename", "UTF-8").alias("content"))
    return versions.audit(own.select("id", "local_path", "size_bytes", "content_sha256"), archive).select("id", "verdict")


@query(f"""SELECT post_id, label, value FROM (SELECT post_id, unnest(['Tender', 'Buyer', 'Method']) AS label, unnest([{_FLAT.format(c='tender_id')}, {_FLAT.format(c='buyer')}, {_FLAT.format(c='method')}]) AS value FROM tenders)""")
def label_tables(spark: SparkSession, d: str) -> DataFrame:
    """Labelled values of all tenders written as tables, also several to a row and again further down, then read."""
    t = table(spark, d, "tenders")
    cell = lambda c: F.concat(F.lit("</th>\n<td class='v'>"), F.coalesce(F.col(c), F.lit("")), F.lit("</td>"))
    html = F.concat(F.lit("<table><tr><th>Tender"), cell("tender_id"), F.lit("<th scope='row'>Buyer"), cell("buyer"), F.lit("</tr><tr><th>Heading</th><th>Method"), cell("method"), F.lit("</tr><tr><th>Buyer</th><td>second</td></tr></table>"))
    return portal_html.label_values(t.select("post_id", html.alias("html")), "post_id")


@query(f"SELECT id AS file_id, NULLIF(trim(regexp_replace(nupco_code, '[^0-9]', '', 'g')), '') AS nupco_code, sn FROM {_ITEMS} WHERE regexp_matches(nupco_code, '^[0-9]{{10,14}}$') AND regexp_matches(sn, '^[0-9]{{1,5}}$')")
def stitched_lines(spark: SparkSession, d: str) -> DataFrame:
    """Coded items written as two lines of text each, then read as one row."""
    items = table(spark, d, "tender_items").where(F.col("nupco_code").rlike("^[0-9]{10,14}$") & F.col("sn").rlike("^[0-9]{1,5}$")).select("id", "sn", "nupco_code").dropDuplicates(["id"])
    written = items.select(F.col("id").alias("file_id"), F.posexplode(F.array(F.concat_ws(" ", "sn", "nupco_code", F.lit("WRITTEN PRODUCT NAME")), F.lit("WRAPPED BEHIND IT EACH 12"))).alias("line_no", "text"))
    return lines.line_items(written.withColumn("page", F.lit(1)), words=None).select("file_id", "nupco_code", "sn")


@query(f"""SELECT attachment_id AS file_id, COUNT(*) AS items, COUNT(NULLIF(nupco_code, '')) AS coded, MIN(description) AS first_text FROM (SELECT DISTINCT attachment_id, id, {_FLAT.format(c='description')} AS description,
  regexp_replace(nupco_code, '[^0-9]', '', 'g') AS nupco_code FROM tender_items WHERE attachment_id IS NOT NULL AND id IS NOT NULL) WHERE length(description) >= 3 GROUP BY 1""")
def text_files(spark: SparkSession, d: str) -> DataFrame:
    """The items of each file written as delimited text, then read: header found, columns named, rows parsed."""
    c, text = F.col, F.lit
    items = table(spark, d, "tender_items").select("attachment_id", "id", "nupco_code", "description").dropDuplicates()
    own = items.where(c("attachment_id").isNotNull() & c("id").isNotNull())
    quoted = lambda x: F.concat(text('"'), F.replace(F.coalesce(x, text("")), text('"'), text('""')), text('"'))
    line = F.concat_ws(";", c("id").cast("string"), quoted(c("nupco_code")), quoted(c("description")), text("EA"), text("1"))
    content = F.concat(text("list of items\nSN;Material Code;Item Description;UOM;Required Quantity\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n"))
    files = own.groupBy(c("attachment_id").alias("file_id")).agg(F.encode(content, "UTF-8").alias("content")).withColumn("name", text("list.csv"))
    read = tabular.sheet_items(sinks.dead_letters(tabular.file_rows(files), AS_OF, 1)[0])
    return read.groupBy("file_id").agg(F.count(F.lit(1)).alias("items"), F.count("nupco_code").alias("coded"), F.min("description").alias("first_text"))


@query("""SELECT l_orderkey AS page_id, COUNT(*) AS lines, ROUND(SUM(l_quantity), 2) AS quantity, ROUND(SUM(l_extendedprice), 2) AS total, COUNT(*) FILTER (WHERE l_quantity <> 0 AND l_extendedprice <> 0) AS with_cost,
  CASE WHEN BOOL_OR(l_tax > 0) THEN 1 ELSE 0 END AS taxed, MIN('DRUG ' || l_partkey) AS first_name, ROUND(SUM(l_discount), 4) AS prices, MAX('M' || l_suppkey) AS last_maker,
  COUNT(*) FILTER (WHERE l_returnflag = 'R') AS with_terms, COUNT(*) FILTER (WHERE l_linestatus = 'O') AS dinars FROM lineitem GROUP BY 1""")
def award_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders written as award decision pages, all four rows of an item included, then read."""
    cells = lambda *cs: F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td class='c'>"), c, F.lit("</td>")) for c in cs], F.lit("</tr>\n"))
    c, text = F.col, F.lit
    head = (
        "<h2>القرار</h2><table class='t'><tr><th>رقم قرار الإحالة</th><td>A1</td><th>حالة الإحالة</th><td>Final</td></tr><tr><th>الجهة المشترية</th><td>[1] Stores</td></tr></table>"
        "<table><tr><th>رقم المناقص</th><td>7</td><th>الجهة المستفيدة</th><td>[27] Clinic</td></tr></table><table>"
    )
    total = F.concat(F.format_string("%.2f", "l_extendedprice"), F.when(c("l_linestatus") == "O", text(" JOD")).otherwise(text("")))
    first = cells(c("l_linenumber").cast("string"), text("51"), text("08-03"), text("30 tab"), text(""), text("0"), text("0"), F.format_string("%.2f", "l_quantity"), total, text("<b>lowest</b>"))
    offer = cells(text("offer"), F.concat(text("[ DRUG "), c("l_partkey").cast("string"), text(" ]")), text("R-1"), F.concat(F.format_string("%.4f", "l_discount"), text(" [ USD ]")))
    maker = cells(F.concat(text("M"), c("l_suppkey").cast("string")), text("JO"), text("2 years"), text("&nbsp;"))
    terms = F.when(c("l_returnflag") == "R", text("<tr><th colspan='2'>شروط خاصة</th><td>cold &amp; dry</td></tr>")).otherwise(text(""))
    heading = F.when(F.max((c("l_tax") > 0).cast("int")) == 1, text("السعر النهائي")).otherwise(text("السعر النهائي غير شامل الضريبة"))
    html = F.concat(text(head + "<tr><th>م</th><th>رمز UNSPSC</th><th>"), heading, text("</th></tr>"), F.array_join(F.collect_list(F.concat(first, offer, maker, terms)), ""), text("</table>"))
    pages = table(spark, d, "lineitem").groupBy(c("l_orderkey").alias("page_id")).agg(html.alias("html"))
    return portal_html.award_rows(pages).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("lines"), F.round(F.sum("awarded_qty"), 2).alias("quantity"), F.round(F.sum("total_value"), 2).alias("total"), F.count("unit_cost").alias("with_cost"), F.max("price_incl_tax").alias("taxed"),
        F.min("scientific_name").alias("first_name"), F.round(F.sum("unit_price"), 4).alias("prices"), F.max("manufacturer").alias("last_maker"), F.count_if(c("conditions") == "cold & dry").alias("with_terms"),
        F.count_if(c("currency") == "JOD").alias("dinars"),
    )


def _alias_case() -> str:
    exact = " ".join(f"WHEN '{a}' THEN '{f}'" for a, f in tabular.FIELD_OF.items())
    held = " ".join(f"WHEN contains(k, '{a}') THEN '{f}'" for a, f in tabular.FIELD_OF.items() if len(a) > 2)
    return f"COALESCE(CASE k {exact} END, CASE {held} END)"


@query(f"""SELECT label, CASE WHEN k <> '' THEN {_alias_case()} END AS field FROM (SELECT label, trim(regexp_replace(lower(label), '[^a-z0-9 ]+', ' ', 'g')) AS k FROM
  (SELECT DISTINCT unnest(json_keys(TRY_CAST(raw_row AS JSON))) AS label FROM tender_items))""")
def header_fields(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "tender_items").select(F.explode(F.map_keys(F.from_json("raw_row", "map<string,string>"))).alias("label")).distinct()
    return labels.select("label", tabular.header_field(F.col("label")).alias("field"))


# --- runs ---


@query("""SELECT run_id, MIN(epoch(changed_at::TIMESTAMPTZ))::BIGINT AS first_change, MAX(epoch(changed_at::TIMESTAMPTZ))::BIGINT AS last_change, COUNT(*) AS changes, COUNT(*) FILTER (WHERE change_kind = 'new') AS new,
  COUNT(*) FILTER (WHERE change_kind = 'update') AS updated, COUNT(*) FILTER (WHERE change_kind = 'delist') AS delisted, COUNT(*) FILTER (WHERE change_kind = 'relist') AS relisted
  FROM (SELECT DISTINCT * FROM tender_history) GROUP BY run_id""")
def run_list(spark: SparkSession, d: str) -> DataFrame:
    return runs.runs_of_history(table(spark, d, "tender_history"))


@query("SELECT run_id, COUNT(*) AS changes FROM (SELECT DISTINCT * FROM tender_history) GROUP BY run_id ORDER BY run_id DESC LIMIT 1")
def latest_run(spark: SparkSession, d: str) -> DataFrame:
    return runs.latest_run(runs.runs_of_history(table(spark, d, "tender_history"))).select("run_id", "changes")


_CELL = "substr(replace(COALESCE(NULLIF(CAST({c} AS VARCHAR), ''), '—'), '|', '\\|'), 1, 70)"
_LAST = "(SELECT MAX(run_id) FROM tender_history)"


@query(f"""WITH h AS (SELECT DISTINCT * FROM tender_history WHERE run_id = {_LAST}),
  b AS (SELECT * FROM tenders WHERE post_id IN (SELECT post_id FROM h WHERE field = '_record')), c AS (SELECT * FROM h WHERE field <> '_record'),
  p AS (SELECT * FROM tenders WHERE category_guess = 'pharma' AND days_to_deadline BETWEEN 0 AND 14)
  SELECT 'totals' AS section, k::INTEGER AS position, text FROM (SELECT ROW_NUMBER() OVER (ORDER BY source) AS k, {" || ' | ' || ".join(_CELL.format(c=x) for x in ('source', 'tenders', 'listed', 'latest'))} AS text FROM
    (SELECT COALESCE(source, 'nupco') AS source, COUNT(*) AS tenders, COUNT(*) FILTER (WHERE is_listed = 1) AS listed, MAX(last_changed_at) AS latest FROM tenders GROUP BY 1))
  UNION ALL SELECT 'new' AS section, k::INTEGER AS position, text FROM (SELECT ROW_NUMBER() OVER (ORDER BY post_id) AS k, {" || ' | ' || ".join(_CELL.format(c=x) for x in ('tender_id', 'title_en', 'status_label', 'submission_ts'))} AS text FROM b) WHERE k <= 60
  UNION ALL SELECT 'changes', k::INTEGER, text FROM (SELECT ROW_NUMBER() OVER (ORDER BY id DESC) AS k, {" || ' | ' || ".join(_CELL.format(c=x) for x in ('tender_id', 'field', 'old_value', 'new_value'))} AS text FROM c) WHERE k <= 40
  UNION ALL SELECT 'closing', k::INTEGER, text FROM (SELECT ROW_NUMBER() OVER (ORDER BY days_to_deadline, post_id) AS k, {" || ' | ' || ".join(_CELL.format(c=x) for x in ('tender_id', 'title_en', 'days_to_deadline'))} AS text FROM p) WHERE k <= 60""")
def run_digest(spark: SparkSession, d: str) -> DataFrame:
    tenders, history = _some(spark, d, "tenders", "tender_history")
    last = history.agg(F.max("run_id")).first()[0]
    return runs.digest(tenders, history, last)


@query(f"""SELECT 'two_current_versions' AS check_name, COUNT(*) AS failures FROM (SELECT post_id, role FROM {_FILES} WHERE is_current = 1 GROUP BY 1, 2 HAVING COUNT(*) > 1)
  UNION ALL SELECT 'items_without_file', COUNT(*) FROM {_ITEMS} WHERE attachment_id IS NULL OR attachment_id NOT IN (SELECT id FROM attachments WHERE id IS NOT NULL)
  UNION ALL SELECT 'items_without_tender', COUNT(*) FROM {_ITEMS} WHERE post_id IS NULL OR post_id NOT IN (SELECT post_id FROM tenders)
  UNION ALL SELECT 'negative_qty', COUNT(*) FROM {_ITEMS} WHERE qty < 0
  UNION ALL SELECT 'dates_not_iso', COUNT(*) FROM tenders WHERE COALESCE(NOT regexp_matches(opening_ts, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'), FALSE) OR COALESCE(NOT regexp_matches(submission_ts, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'), FALSE)
    OR COALESCE(NOT regexp_matches(bid_opening_ts, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$'), FALSE)
  UNION ALL SELECT 'tenders_without_id', COUNT(*) FROM tenders WHERE tender_id IS NULL
  UNION ALL SELECT 'coded_per_mille', (COUNT(*) FILTER (WHERE nupco_code IS NOT NULL OR rdl_code IS NOT NULL) * 1000 // GREATEST(COUNT(*), 1))::BIGINT FROM {_ITEMS}
  UNION ALL SELECT 'items_without_code', COUNT(*) FROM {_ITEMS} WHERE nupco_code IS NULL AND rdl_code IS NULL""")
def dq_checks(spark: SparkSession, d: str) -> DataFrame:
    return runs.quality_checks(*_some(spark, d, "tenders", "tender_items", "attachments"))


@query("SELECT source, COUNT(*) AS tenders, COUNT(*) FILTER (WHERE tender_id IS NOT NULL) AS with_id, COUNT(*) FILTER (WHERE booklet_price_sar IS NOT NULL) AS priced FROM tenders GROUP BY source")
def conformed_tenders(spark: SparkSession, d: str) -> DataFrame:
    """Tenders brought to the stored schema from a frame with other letter case, a lacking and an extra column."""
    odd = table(spark, d, "tenders").withColumnRenamed("tender_id", "Tender_ID").drop("method").withColumn("extra", F.lit(1))
    return conform(odd, "tenders").groupBy("source").agg(F.count(F.lit(1)).alias("tenders"), F.count("tender_id").alias("with_id"), F.count("booklet_price_sar").alias("priced"))

"""Queries for the data problems of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bidloom.operators import instants, satellites, schema_drift, snapshots, units
from bidloom.session import table


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.label_changes(table(spark, d, "tender_items"), table(spark, d, "item_files"))


def p2_table(spark: SparkSession, d: str) -> DataFrame:
    return schema_drift.consistent_items(table(spark, d, "tender_items"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, d, "tender_snapshots"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    # Versions that begin and end at one instant may repeat; the query lists each row once.
    return satellites.validity_view(satellites.satellite_rows(table(spark, d, "tender_history"))).distinct()


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return units.converted_items(table(spark, d, "tender_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return instants.field_instants(table(spark, d, "tenders"))




def _units_sql() -> str:
    """Unit conversion for texts with one separator per number, from the same alias table."""
    rows = ", ".join(f"('{a}', '{k}', '{b}', {f})" for a, (k, b, f) in units.ALIASES.items())
    words = {k: "|".join(sorted((a for a, v in units.ALIASES.items() if v[0] in k), key=len, reverse=True)) for k in (("measure", "count"), ("times",))}
    number = "[0-9]+(?:[.,٬][0-9]+| [0-9][0-9][0-9])?"

    def first(text: str, kind) -> str:
        # Digits and letters are set apart first, since this engine has no look-behind.
        apart = f"' ' || regexp_replace(regexp_replace({text}, '([0-9])', ' \\1 ', 'g'), '[^\\p{{L}}]+', ' ', 'g') || ' '"
        return f"NULLIF(regexp_extract({apart}, ' ({words[kind]}) ', 1), '')"

    def value(text: str) -> str:
        sep, whole, part = (f"regexp_extract({text}, '^([0-9]+)([^0-9])?([0-9]+)?$', {i})" for i in (2, 1, 3))
        groups = f"(length({part}) = 3 AND ({sep} <> '.' OR dots))"
        return f"TRY_CAST(NULLIF(CASE WHEN {sep} = '' THEN {text} WHEN {groups} THEN {whole} || {part} ELSE {whole} || '.' || {part} END, '') AS DECIMAL(28, 9))"

    digits = "translate({c}, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')"
    return f"""WITH a(alias, kind, base, factor) AS (VALUES {rows}),
      r AS (SELECT DISTINCT id, qty, post_id >= 1000000000000 AS dots, upper({digits.format(c='qty_raw')}) AS q, upper({digits.format(c='uom')}) AS u FROM tender_items WHERE qty_raw IS NOT NULL AND id IS NOT NULL),
      n AS (SELECT *, regexp_extract(q, '{number}') AS n0, regexp_extract(q, '^[^0-9]*{number}(.*)$', 1) AS b, COALESCE(u, '') AS v FROM r),
      w AS (SELECT id, qty, {value('n0')} AS n, {value(f"regexp_extract(b, '{number}')")} AS qc, {value(f"regexp_extract(v, '{number}')")} AS uc,
        {first('b', ('measure', 'count'))} AS qw, {first('b', ('times',))} AS qt, {first('v', ('measure', 'count'))} AS uw, {first('v', ('times',))} AS ut FROM n),
      f AS (SELECT w.*, qa.base AS qb, qa.factor AS qf, ua.base AS ub, ua.factor AS uf, qm.factor AS qtf, um.factor AS utf FROM w LEFT JOIN a qa ON qa.alias = qw LEFT JOIN a ua ON ua.alias = uw
        LEFT JOIN a qm ON qm.alias = qt LEFT JOIN a um ON um.alias = ut),
      c AS (SELECT id, qty, COALESCE(qb, CASE WHEN qw IS NULL THEN ub END, 'each') AS base_unit,
        CAST(n AS DECIMAL(19, 6)) * CAST(COALESCE(qtf, 1) * CASE WHEN qw IS NOT NULL OR qc IS NOT NULL THEN COALESCE(qf, uf, 1) * COALESCE(qc, 1)
          ELSE COALESCE(uf, 1) * COALESCE(uc, 1) * (CASE WHEN utf IS NOT NULL AND utf IS DISTINCT FROM qtf THEN utf ELSE 1 END) END AS DECIMAL(19, 6)) AS amount FROM f WHERE n IS NOT NULL)
      SELECT DISTINCT id AS item_id, base_unit, CAST(amount AS BIGINT) AS base_qty FROM c WHERE qty IS NULL OR CAST(amount AS DOUBLE) <> qty"""


_DRIFT = r"""WITH e AS (SELECT t.attachment_id, t.sn, t.nupco_code, t.description, t.uom, t.qty_raw, trim(regexp_replace(lower(j.key), '[^a-z0-9]+', ' ', 'g')) AS label,
    CASE j.type WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'ARRAY' THEN 'array' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind,
    CASE j.type WHEN 'ARRAY' THEN array_to_string(json_extract_string(j.value, '$[*]'), ' ') WHEN 'OBJECT' THEN array_to_string(json_extract_string(j.value, '$.*'), ' ') ELSE j.value ->> '$' END AS text
    FROM (SELECT *, TRY_CAST(raw_row AS JSON) AS js FROM tender_items WHERE attachment_id IS NOT NULL) t, json_each(t.js) j),
  c AS (SELECT attachment_id, label, string_agg(DISTINCT kind, '+' ORDER BY kind) AS kinds, COUNT(kind) AS filled, COUNT(*) FILTER (WHERE sn = text) AS f1,
    COUNT(*) FILTER (WHERE nupco_code = regexp_replace(text, '[^0-9]', '', 'g')) AS f2, COUNT(*) FILTER (WHERE description = text) AS f3, COUNT(*) FILTER (WHERE uom = text) AS f4, COUNT(*) FILTER (WHERE qty_raw = text) AS f5 FROM e GROUP BY 1, 2),
  m AS (SELECT label, CASE WHEN 2 * SUM(f1) > SUM(filled) THEN 'sn' WHEN 2 * SUM(f2) > SUM(filled) THEN 'nupco_code' WHEN 2 * SUM(f3) > SUM(filled) THEN 'description' WHEN 2 * SUM(f4) > SUM(filled) THEN 'uom'
    WHEN 2 * SUM(f5) > SUM(filled) THEN 'qty_raw' ELSE 'label ' || label END AS field FROM c GROUP BY label),
  s AS (SELECT i.feed, i.file_no, i.attachment_id, m.field, MIN(c.label) AS label, MIN(c.kinds) AS kinds FROM c JOIN m USING (label) JOIN item_files i USING (attachment_id) GROUP BY 1, 2, 3, 4),
  p AS (SELECT n.attachment_id, n.feed, n.file_no FROM item_files n JOIN item_files o ON o.feed = n.feed AND o.file_no = n.file_no - 1),
  k AS (SELECT p.attachment_id, a.label AS la, a.kinds AS ka, NULL AS lb, NULL AS kb, FALSE AS old FROM p JOIN s a ON a.attachment_id = p.attachment_id LEFT JOIN s b ON b.feed = p.feed AND b.file_no = p.file_no - 1 AND b.field = a.field WHERE b.field IS NULL
    UNION ALL SELECT p.attachment_id, b.label, NULL, NULL, NULL, TRUE FROM p JOIN s b ON b.feed = p.feed AND b.file_no = p.file_no - 1 LEFT JOIN s a ON a.attachment_id = p.attachment_id AND a.field = b.field WHERE a.field IS NULL
    UNION ALL SELECT p.attachment_id, a.label, a.kinds, b.label, b.kinds, FALSE FROM p JOIN s a ON a.attachment_id = p.attachment_id JOIN s b ON b.feed = p.feed AND b.file_no = p.file_no - 1 AND b.field = a.field)
  SELECT attachment_id, CASE WHEN old THEN 'removed' ELSE 'added' END AS change_kind, la AS label FROM k WHERE lb IS NULL
  UNION ALL SELECT attachment_id, 'renamed', la FROM k WHERE la <> lb UNION ALL SELECT attachment_id, 'retyped', la FROM k WHERE lb IS NOT NULL AND ka <> kb"""

_CHANGES = """WITH s AS (SELECT snapshot_no, post_id, lower(trim(content_hash)) AS h, is_listed AS l FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY snapshot_no, post_id
    ORDER BY CAST(last_seen_at AS TIMESTAMPTZ) DESC, content_hash DESC NULLS LAST, is_listed DESC NULLS LAST) AS k FROM tender_snapshots) WHERE k = 1)
  SELECT n.snapshot_no, n.post_id, CASE WHEN o.post_id IS NULL THEN 'added' ELSE 'changed' END AS change_kind FROM s n LEFT JOIN s o ON o.post_id = n.post_id AND o.snapshot_no = n.snapshot_no - 1
    WHERE n.snapshot_no > 1 AND (o.post_id IS NULL OR n.h IS DISTINCT FROM o.h OR n.l IS DISTINCT FROM o.l)
  UNION ALL SELECT o.snapshot_no + 1, o.post_id, 'removed' FROM s o LEFT JOIN s n ON n.post_id = o.post_id AND n.snapshot_no = o.snapshot_no + 1
    WHERE n.post_id IS NULL AND o.snapshot_no < (SELECT MAX(snapshot_no) FROM tender_snapshots)"""

_VALUE = r"regexp_replace(trim(COALESCE({c}, '')), '^([+-]?[0-9]+)\.0*$', '\1')"
_VERSIONS = f"""WITH h AS (SELECT DISTINCT id, post_id, field, {_VALUE.format(c='old_value')} AS o, {_VALUE.format(c='new_value')} AS v, CAST(changed_at AS TIMESTAMPTZ) AS t FROM tender_history),
  r AS (SELECT post_id, MIN(t) AS t FROM h WHERE field = '_record' GROUP BY 1),
  w AS (SELECT *, ROW_NUMBER() OVER x AS n, LAG(v) OVER x AS p FROM h WHERE field <> '_record' WINDOW x AS (PARTITION BY post_id, field ORDER BY t, id)),
  a AS (SELECT w.post_id, field, r.t, -1 AS id, o AS v FROM w LEFT JOIN r USING (post_id) WHERE n = 1 UNION ALL SELECT post_id, field, t, id, v FROM w WHERE v <> COALESCE(p, o)),
  e AS (SELECT *, LEAD(t) OVER (PARTITION BY post_id, field ORDER BY id <> -1, t, id) AS z FROM a)
  SELECT post_id, field, COALESCE(strftime(t AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ'), '') AS valid_from, COALESCE(strftime(z AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ'), '') AS valid_to, v AS val FROM e"""

_STAMP = r"^(?:[A-Za-z]{3}, )?(?:(\d{1,2})[/.](\d{1,2})[/.](\d{4})|(\d{4})-(\d\d)-(\d\d)|(\d{1,2})[ -]([A-Za-z]{3})[ -](\d{4}))(?:[ T](\d{1,2}):(\d\d)(?::(\d\d))?(?:\.\d+)?(?: (AM|PM|ص|م))?)?\s*(.*)$"
_MONTHS = "['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec']"
_INSTANTS = f"""WITH v AS (SELECT post_id, source, field, trim(translate(text, '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789')) AS s FROM (SELECT post_id, source,
    unnest(['opening_date', 'submission_deadline', 'bid_opening']) AS field, unnest([opening_date, submission_deadline, bid_opening]) AS text FROM tenders) WHERE text IS NOT NULL),
  p AS (SELECT *, regexp_extract(s, '{_STAMP}', ['d1', 'm1', 'y1', 'y2', 'm2', 'd2', 'd3', 'n3', 'y3', 'h', 'mi', 'ss', 'half', 'z']) AS g FROM v WHERE regexp_matches(s, '{_STAMP}')),
  c AS (SELECT *, g.y1 || g.y2 || g.y3 AS y, CASE WHEN g.n3 <> '' THEN list_position({_MONTHS}, lower(g.n3))::VARCHAR ELSE g.m1 || g.m2 END AS m, g.d1 || g.d2 || g.d3 AS d,
    COALESCE(TRY_CAST(g.h AS INTEGER), 0) AS h FROM p),
  w AS (SELECT *, TRY_CAST(y || '-' || lpad(m, 2, '0') || '-' || lpad(d, 2, '0') || ' ' || lpad((CASE WHEN g.half = '' THEN h ELSE h % 12 + CASE WHEN g.half IN ('PM', 'م') THEN 12 ELSE 0 END END)::VARCHAR, 2, '0')
    || ':' || COALESCE(NULLIF(g.mi, ''), '00') || ':' || COALESCE(NULLIF(g.ss, ''), '00') AS TIMESTAMP) AS t, regexp_extract(g.z, '^(Z|UTC|GMT)?(?:([+-])(\\d{{1,2}}):?(\\d\\d)?)?$', ['u', 'sign', 'oh', 'om']) AS o FROM c),
  f AS (SELECT *, CASE g.z WHEN '' THEN CASE source WHEN 'nupco' THEN 'Asia/Riyadh' ELSE 'Asia/Amman' END WHEN '(Riyadh time)' THEN 'Asia/Riyadh' WHEN '(KSA time)' THEN 'Asia/Riyadh' WHEN '(Amman time)' THEN 'Asia/Amman'
    ELSE CASE WHEN o.u = '' AND o.sign = '' THEN g.z END END AS zone FROM w WHERE t IS NOT NULL),
  b AS (SELECT *, t - ((t - INTERVAL 1 DAY) - timezone(zone, t - INTERVAL 1 DAY) AT TIME ZONE 'UTC') AS early, t - ((t + INTERVAL 1 DAY) - timezone(zone, t + INTERVAL 1 DAY) AT TIME ZONE 'UTC') AS late FROM f WHERE zone IS NOT NULL),
  u AS (SELECT post_id, field, CASE WHEN timezone(zone, early AT TIME ZONE 'UTC') = t THEN early WHEN timezone(zone, late AT TIME ZONE 'UTC') = t THEN late ELSE early END AS i FROM b
    UNION ALL SELECT post_id, field, t - (CASE o.sign WHEN '-' THEN -1 ELSE 1 END) * to_minutes((COALESCE(TRY_CAST(o.oh AS INTEGER), 0) * 60 + COALESCE(TRY_CAST(o.om AS INTEGER), 0))::INTEGER) FROM f WHERE zone IS NULL
    UNION ALL SELECT post_id, field, make_timestamp((CASE WHEN length(s) <= 11 THEN s::BIGINT WHEN length(s) <= 14 THEN s::BIGINT // 1000 ELSE s::BIGINT // 1000000 END) * 1000000) FROM v WHERE regexp_matches(s, '^[0-9]{{5,17}}$'))
  SELECT post_id, field, strftime(i, '%Y-%m-%dT%H:%M:%SZ') AS instant_utc FROM u"""

QUERIES = {f.__name__: f for f in (p2_found, p2_table, p3_found, p4_found, p6_found, p7_found)}
ORACLES = {"p2_found": _DRIFT, "p3_found": _CHANGES, "p4_found": _VERSIONS, "p6_found": _units_sql(), "p7_found": _INSTANTS}

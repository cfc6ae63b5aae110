"""Schemas of the seven stored tables, and conforming frames to them by name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TYPES = {"L": T.LongType(), "I": T.IntegerType(), "D": T.DoubleType(), "S": T.StringType()}


def _schema(**columns: str) -> T.StructType:
    """columns: one letter of a type to the names that have it, in any order."""
    return T.StructType([T.StructField(name, _TYPES[letter]) for letter, names in columns.items() for name in names.split()])


TENDERS = _schema(
    L="post_id",
    S="tender_id url slug title_en title_ar status_label status_slugs opening_date submission_deadline bid_opening buy_url tender_kind opening_ts submission_ts "
    "bid_opening_ts category_guess lang sitemap_lastmod detail_fetched_at discovered_via content_hash first_seen_at last_seen_at last_changed_at source country "
    "subcategory buyer method",
    D="booklet_price_sar total_qty",
    I="tender_seq tender_year days_to_deadline item_count attachment_count is_listed is_terminal fiscal_year",
)
HISTORY = _schema(L="id post_id", S="tender_id field old_value new_value change_kind changed_at", I="run_id")
ATTACHMENTS = _schema(
    L="id post_id size_bytes",
    S="tender_id role url filename ext content_sha256 etag http_last_modified local_path parse_status first_seen_at last_seen_at last_changed_at",
    I="version is_current parse_rows",
)
ITEMS = _schema(
    L="id attachment_id post_id",
    S="tender_id sn item_no nupco_code description uom qty_raw item_group itemized category_guess code_group raw_row generic_name generic_name_ar rdl_code unspsc demand_json",
    D="qty",
    I="is_accessory source_page row_index",
)
FAILURES = _schema(L="id attachment_id", S="tender_id role local_path reason occurred_at", I="run_id")
RUNS = _schema(I="run_id tenders_seen tenders_new tenders_changed files_checked files_changed items_parsed errors", S="mode started_at finished_at status notes")
AWARDS = _schema(
    L="id post_id",
    S="source tender_id award_no award_status published_at buyer beneficiary_code beneficiary supplier_no supplier supplier_country po_no item_no unspsc rdl_code "
    "scientific_name brand manufacturer origin_country registration shelf_life pack unit_size currency award_reason conditions first_seen_at last_seen_at",
    D="pack_size free_qty_pct discount_pct awarded_qty unit_price total_value unit_cost",
    I="price_incl_tax",
)

TABLES = {
    "tenders": TENDERS, "tender_history": HISTORY, "attachments": ATTACHMENTS, "tender_items": ITEMS, "parse_failures": FAILURES, "run_log": RUNS, "awards": AWARDS,
}

#: Values of columns that a frame lacks; all others are null.
DEFAULTS = {
    "tenders": {"item_count": 0, "attachment_count": 0, "is_listed": 1, "is_terminal": 0, "source": "nupco", "country": "SA"},
    "attachments": {"version": 1, "is_current": 1, "parse_rows": 0, "parse_status": "pending"},
    "tender_items": {"is_accessory": 0},
}


def conform(df: DataFrame, name: str) -> DataFrame:
    """The frame with exactly the columns of a table: matched by name (letter case ignored), lacking ones with their default, extra ones
    dropped, values cast or null where they can't be."""
    own = {c.lower(): c for c in df.columns}
    defaults = DEFAULTS.get(name, {})

    def column(f: T.StructField):
        if f.name in own:
            return F.col(f"`{own[f.name]}`").try_cast(f.dataType).alias(f.name)
        return F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name)

    return df.select(*[column(f) for f in TABLES[name].fields])

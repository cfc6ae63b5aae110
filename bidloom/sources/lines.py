"""Item lists without ruled tables: words on pages to visual lines, lines to items.

Input are words (file_id, page, x0, x1, top, text), as a PDF reader gives them, or ready lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.functions import classify
from bidloom.functions import scalars as X
from bidloom.sources.tabular import FIELD_OF, header_field, header_fields, header_key

# Unit words that may close a line's description.
UNIT_WORDS = (
    "each", "ea", "pac", "pack", "packet", "pkt", "box", "bx", "vial", "kit", "set", "pcs", "piece", "pieces", "btl", "bottle", "amp", "ampoule", "tab", "tablet", "cap",
    "capsule", "tube", "roll", "bag", "carton", "ctn", "case", "unit", "units", "mtr", "meter", "ltr", "liter", "litre", "gm", "kg", "mg", "ml", "dz", "dozen", "tin", "jar",
    "pouch", "strip", "sachet", "cyl", "pair", "-",
)

# The shapes of a row, of its mark and of its closing amount.
_ROW = r"^\s*(?:([0-9]{1,5})[.)]?\s+)?([0-9]{10,14})\s+(.+)$"
_WORD = r"[,.]*(?:" + "|".join(sorted(UNIT_WORDS, key=len, reverse=True)) + r")[,.]*"
_UNITS = r"(?i)(?:(?:^|\s+)" + _WORD + r")+$"
_FIRST_UNIT = r"(?i)(?:^|\s)[,.]*((?:" + "|".join(sorted(UNIT_WORDS, key=len, reverse=True)) + r"))[,.]*(?:\s+" + _WORD + r")*$"
_MARK = r"(?i)\b(non[-\s]?itemi[sz]ed|itemi[sz]ed)\b"
_AMOUNT = r"^(.*?)[\s|]+([0-9,]+(?:\.[0-9]+)?)\s*$"


def visual_lines(words: DataFrame, tolerance: float = 3.0) -> DataFrame:
    """(file_id, page, line_no, text, words): words of one page whose tops lie within `tolerance` of the line's first word, left to right.

    A page's words are folded, from top to bottom and left to right, into an array of lines: each word either joins the last line or
    opens one. Whether it joins depends on that line's first word, so a page is one fold; pages are bounded by what a sheet holds.
    Words without text or place are left out.
    """
    whole = words.where(F.col("text").isNotNull() & F.col("top").isNotNull() & F.col("x0").isNotNull())
    placed = F.struct(F.round("top", 1).alias("at"), F.col("x0").cast("double").alias("x0"), F.col("x1").cast("double").alias("x1"), F.col("top").cast("double").alias("top"), "text")
    page = whole.groupBy("file_id", "page").agg(F.array_sort(F.collect_list(placed)).alias("w"))
    word = "struct<x0:double,x1:double,text:string>"

    def take(lines: Column, w: Column) -> Column:
        own = F.array(F.struct(w["x0"].alias("x0"), w["x1"].alias("x1"), w["text"].alias("text")))
        last = F.get(lines, F.size(lines) - 1)
        joined = F.array(F.struct(last["top"].alias("top"), F.concat(last["words"], own).alias("words")))
        opened = F.array(F.struct(w["top"].alias("top"), own.alias("words")))
        near = (F.size(lines) > 0) & (F.abs(w["top"] - last["top"]) <= tolerance)
        return F.when(near, F.concat(F.slice(lines, 1, F.greatest(F.size(lines) - 1, F.lit(0))), joined)).otherwise(F.concat(lines, opened))

    folded = page.select("file_id", "page", F.posexplode(F.aggregate("w", F.array().cast(f"array<struct<top:double,words:array<{word}>>>"), take)).alias("line_no", "l"))
    sorted_words = F.array_sort(F.col("l.words"))
    return folded.select("file_id", "page", "line_no", F.trim(F.array_join(F.transform(sorted_words, lambda w: w["text"]), " ")).alias("text"), sorted_words.alias("words"))


def header_columns(words: Column, gap: float = 9.0) -> Column:
    """The columns that a header line names: array of (field, left, right), or null where it names neither a description nor a code.

    Words closer than `gap` make one label; a column reaches to the middle between its label and the next.
    """
    none = F.array().cast("array<struct<x0:double,x1:double,label:string>>")

    def glue(acc: Column, w: Column) -> Column:
        last = F.get(acc, F.size(acc) - 1)
        joined = F.struct(last["x0"].alias("x0"), w["x1"].alias("x1"), F.concat_ws(" ", last["label"], w["text"]).alias("label"))
        alone = F.struct(w["x0"].alias("x0"), w["x1"].alias("x1"), w["text"].alias("label"))
        close = (F.size(acc) > 0) & (w["x0"] - last["x1"] <= gap)
        return F.when(close, F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined))).otherwise(F.concat(acc, F.array(alone)))

    labels = F.filter(F.transform(F.aggregate(words, none, glue), lambda p: F.struct(header_field(p["label"]).alias("field"), p["x0"].alias("x0"), p["x1"].alias("x1"))), lambda p: p["field"].isNotNull())
    ranged = F.transform(labels, lambda p, i: F.struct(
        p["field"].alias("field"), F.when(i == 0, F.lit(0.0)).otherwise((F.get(labels, i - 1)["x1"] + p["x0"]) / 2).alias("left"),
        F.when(i == F.size(labels) - 1, F.lit(10_000.0)).otherwise((p["x1"] + F.get(labels, i + 1)["x0"]) / 2).alias("right"),
    ))
    return F.when(F.exists(labels, lambda p: p["field"].isin("description", "nupco_code")), ranged)


def names_columns(text: Column) -> Column:
    """Whether a line without word places reads like a header: two or more words or phrases that are column labels, one of a description or code."""
    parts = F.transform(F.split(text, r"\s{2,}|\t|\|"), header_field)
    return F.exists(parts, lambda f: F.coalesce(f.isin("description", "nupco_code"), F.lit(False))) & (F.size(F.array_compact(parts)) >= 2)


def peeled(text: Column) -> Column:
    """struct(body, uom, itemized, qty_raw): a row's text without its closing amount, its ITEMIZED mark and its closing unit words."""
    qty = X.none_if_empty(F.regexp_extract(text, _AMOUNT, 2))
    body = F.when(qty.isNotNull(), F.trim(F.regexp_extract(text, _AMOUNT, 1))).otherwise(text)
    mark = X.none_if_empty(F.upper(F.regexp_extract(body, _MARK, 1)))
    unmarked = F.trim(F.concat_ws(" ", F.split(body, _MARK, 2)))
    unit = X.none_if_empty(F.regexp_extract(unmarked, _FIRST_UNIT, 1))
    bare = F.regexp_replace(F.regexp_replace(X.one_line(F.regexp_replace(unmarked, _UNITS, "")), r"^[\s,;|]+", ""), r"[\s,;|]+$", "")
    return F.struct(X.none_if_empty(bare).alias("body"), unit.alias("uom"), mark.alias("itemized"), qty.alias("qty_raw"))


def line_items(lines: DataFrame, words: str | None = "words") -> DataFrame:
    """Items of lines (file_id, page, line_no, text[, words]): a line with a code of 10 to 14 digits starts one, the lines below continue it.

    Rows are islands: a running count of starts numbers them in the order of pages and lines, also over page ends. A
    continuation adds to the description and fills unit, mark and amount where they are missing. Lines that only repeat a column
    label, headers, page numbers, addresses, bare numbers and lines of two characters or fewer continue nothing. Descriptions of fewer than three characters start nothing.
    The order is the file's own, so a file is one group; files are bounded by their pages.
    """
    text = F.trim("text")
    start = text.rlike(_ROW)
    noise = (F.length(text) <= 2) | text.rlike(r"^[0-9]+$") | text.rlike(r"(?i)page \d+ of \d+|www\.")
    header = F.coalesce(header_columns(F.col(words)).isNotNull(), F.lit(False)) if words else names_columns(text)
    rest = F.when(start, F.trim(F.regexp_extract(text, _ROW, 3))).otherwise(text)
    read = lines.where((text != "") & ~header_key(text).isin(list(FIELD_OF))).select(
        "file_id", "page", "line_no", text.alias("text"), start.alias("start"), F.regexp_extract(text, _ROW, 1).alias("sn"), F.regexp_extract(text, _ROW, 2).alias("code"), peeled(rest).alias("p"),
        (noise | header).alias("noise"),
    )
    kept = read.where(F.when(F.col("start"), F.length("p.body") >= 3).otherwise(~F.col("noise")))
    order = Window.partitionBy("file_id").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = kept.withColumn("item", F.sum(F.col("start").cast("long")).over(order)).where(F.col("item") > 0)
    at = F.struct("page", "line_no")
    first = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), at))
    flat = numbered.select("file_id", "item", "page", "line_no", "start", "text", "sn", "code", "p.body", "p.uom", "p.itemized", "p.qty_raw")
    items = flat.groupBy("file_id", "item").agg(
        F.min(F.when(F.col("start"), at)).alias("at"), F.max(F.when(F.col("start"), F.col("sn"))).alias("sn"), F.max(F.when(F.col("start"), F.col("code"))).alias("nupco_code"),
        F.array_sort(F.collect_list(F.when(F.col("body").isNotNull(), F.struct("page", "line_no", "body")))).alias("parts"),
        first("uom").alias("uom"), first("itemized").alias("itemized"), first("qty_raw").alias("qty_raw"), F.max(F.when(F.col("start"), F.col("text"))).alias("raw_row"),
    )
    described = items.withColumn("description", X.clean_text(F.array_join(F.transform("parts", lambda p: p["body"]), " ")))
    return described.select(
        "file_id", F.col("at.page").alias("source_page"), F.col("at.line_no").alias("row_index"), X.none_if_empty(F.col("sn")).alias("sn"), "nupco_code", "description", "uom", "itemized", "qty_raw",
        X.digits_number(F.col("qty_raw")).alias("qty"), classify.item_category(F.col("nupco_code"), F.col("description")).alias("category_guess"),
        X.code_group(F.col("nupco_code")).alias("code_group"), classify.accessory(F.col("description")).alias("is_accessory"), F.substring("raw_row", 1, 4000).alias("raw_row"),
    )


def table_rows(cells: DataFrame, scan: int = 6) -> DataFrame:
    """(file_id, page, table_no, row_index, cells, fields): rows of ruled tables (file_id, page, table_no, row_index, cells) with their columns' fields.

    A header among a table's first six rows holds for it and, until the next header, for the tables and pages after it; rows up to the header are left out.
    """
    heads = cells.where(F.col("row_index") < scan).withColumn("fields", header_fields(F.col("cells"))).where(F.col("fields").isNotNull())
    own = heads.groupBy("file_id", "page", "table_no").agg(F.min_by(F.struct("row_index", "fields"), "row_index").alias("h"))
    tables = cells.select("file_id", "page", "table_no").distinct().join(own, ["file_id", "page", "table_no"], "left")
    order = Window.partitionBy("file_id").orderBy("page", "table_no").rowsBetween(Window.unboundedPreceding, 0)
    carried = tables.select("file_id", "page", "table_no", F.coalesce(F.col("h.row_index"), F.lit(-1)).alias("head_row"), F.last("h.fields", ignorenulls=True).over(order).alias("fields"))
    return cells.join(carried.where(F.col("fields").isNotNull()), ["file_id", "page", "table_no"]).where(F.col("row_index") > F.col("head_row")).drop("head_row")


def text_layer(pages: DataFrame, sample: int = 3, least: int = 50) -> DataFrame:
    """(file_id, has_text): whether the first three pages (file_id, page, text) hold 50 characters or more; files without are scans."""
    return pages.where(F.col("page") <= sample).groupBy("file_id").agg((F.sum(F.length(F.coalesce("text", F.lit("")))) >= least).alias("has_text"))

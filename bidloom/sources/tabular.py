"""Item lists from delimited text and workbooks: bytes to rows, rows to items.

Files are a frame with file_id, name and content (binary), as `binaryFile` gives. A file is decoded in a stream of rows by a pandas
function; finding the header and reading items works per sheet on rows that were split out, so a long sheet is never held whole.
"""

from __future__ import annotations

import csv
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.functions import classify
from bidloom.functions import scalars as X

#: Rows of a sheet in which the header may stand, rows from which a missing description column is guessed.
HEADER_ROWS, SNIFF_ROWS = 40, 25
ENCODINGS = ("utf-8-sig", "utf-8", "cp1256", "latin-1")

# Labels of columns by field; earlier ones go first where a longer label holds several.
ALIASES: dict[str, tuple[str, ...]] = {
    "sn": ("sn", "s n", "s.n", "sr", "sr no", "serial", "no", "#", "seq"),
    "item_no": ("item no", "item number", "itemno", "item code", "item"),
    "nupco_code": ("nupco code", "srm code", "generic code", "sap code", "material code", "material number", "code", "sap generic code"),
    "description": (
        "item description", "description", "sap generic name", "generic name", "item name", "material description", "desc", "generic material text", "material text",
        "item text", "short text", "product description", "drug name", "trade name",
    ),
    "uom": ("uom", "unit", "unit of measure", "units"),
    "qty": (
        "qty", "quantity", "requested quantity", "initial qty", "total qty", "req qty", "annual qty", "estimated qty", "sum of org open quantity", "org open quantity",
        "open quantity", "required quantity", "total quantity",
    ),
    "item_group": ("group", "groups", "group no", "group number"),
    "itemized": ("itemized", "itemised", "item type"),
}
FIELD_OF = {alias: field for field, aliases in ALIASES.items() for alias in aliases}


def header_key(label: Column) -> Column:
    """A column label in lower case, runs of other characters than a-z, 0-9 and blanks as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(label, F.lit(""))), "[^a-z0-9 ]+", " "))


def header_field(label: Column) -> Column:
    """The field of a column label: of the equal alias, else of the first alias of three letters or more that the label holds; else null."""
    key = header_key(label)
    exact = F.create_map(*[F.lit(x) for kv in FIELD_OF.items() for x in kv])[key]
    held = F.filter(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(f).alias("f")) for a, f in FIELD_OF.items() if len(a) > 2]), lambda e: F.contains(key, e["a"]))
    return F.when(key != "", F.coalesce(exact, F.get(held, F.lit(0))["f"]))


def header_fields(cells: Column) -> Column:
    """The field of each cell of a row, or null where the row is no header: it must name a description or a code."""
    fields = F.transform(cells, header_field)
    return F.when(F.arrays_overlap(fields, F.array(F.lit("description"), F.lit("nupco_code"))), fields)


def file_kind(content: Column, name: Column) -> Column:
    """pdf, xlsx, xls or text: by the first bytes, else by the extension."""
    head = F.hex(F.substring(content, 1, 4))
    extension = F.lower(F.regexp_extract(name, r"\.([A-Za-z0-9]+)$", 1))
    by_name = F.when(extension == "pdf", "pdf").when(extension.isin("xlsx", "xlsm"), "xlsx").when(extension == "xls", "xls").when(extension.isin("csv", "txt"), "text")
    return F.when(head == "25504446", "pdf").when(head == "504B0304", "xlsx").when(head == "D0CF11E0", "xls").otherwise(by_name)


def _decoded(content: bytes) -> str:
    """Text in the first encoding that takes all bytes; the last one takes any."""

    def tried(encoding: str) -> str | None:
        try:
            return content.decode(encoding)
        except UnicodeDecodeError:
            return None

    return next(t for t in map(tried, ENCODINGS) if t is not None)


def _delimiter(text: str) -> str:
    """The sign among , ; tab | that parts the first lines into the most cells and does so most evenly; a comma if none does."""
    first = [line for line in text[:8000].splitlines()[:20] if line.strip()]
    counts = {sign: sorted(line.count(sign) for line in first) for sign in ",;\t|"}
    return max(counts, key=lambda sign: (counts[sign][len(first) // 2], sum(counts[sign])) if first else (0, 0))


def _text_rows(content: bytes) -> Iterator[tuple[str, int, list]]:
    text = _decoded(content)
    for n, row in enumerate(csv.reader(io.StringIO(text), delimiter=_delimiter(text))):
        yield "", n, row


_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def _column_number(reference: str) -> int:
    number = 0
    for ch in re.match("[A-Z]+", reference)[0]:
        number = number * 26 + ord(ch) - 64
    return number - 1


def _workbook_rows(content: bytes) -> Iterator[tuple[str, int, list]]:
    """Rows of all sheets, streamed; parts of the archive that hold no cells (links to other books above all) are never opened."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            with book.open("xl/sharedStrings.xml") as f:
                for _, node in ElementTree.iterparse(f):
                    if node.tag == f"{_MAIN}si":
                        shared.append("".join(t.text or "" for t in node.iter(f"{_MAIN}t")))
                        node.clear()
        for sheet in sorted((n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0])):
            with book.open(sheet) as f:
                for n, (_, node) in enumerate((e for e in ElementTree.iterparse(f) if e[1].tag == f"{_MAIN}row")):
                    row: list = []
                    for k, cell in enumerate(node.iter(f"{_MAIN}c")):
                        at = _column_number(cell.get("r")) if cell.get("r") else k
                        row += [None] * (at + 1 - len(row))
                        value = cell.find(f"{_MAIN}v")
                        if cell.get("t") == "inlineStr":
                            row[at] = "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
                        elif value is not None:
                            row[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
                    yield sheet, n, row
                    node.clear()


def file_rows(files: DataFrame) -> DataFrame:
    """(file_id, sheet, row_index, cells, error): the rows of text files and workbooks, at most 300,000 per sheet.

    A file that can't be read gives one row with the error (at most 500 characters) and null cells: the dead letter.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for file_id, kind, content in zip(pdf["file_id"], pdf["kind"], pdf["content"]):
                out: list[tuple] = []
                try:
                    if kind not in ("text", "xlsx"):
                        raise ValueError(f"no reader for {kind or 'unknown'} files")
                    for sheet, n, row in (_text_rows if kind == "text" else _workbook_rows)(bytes(content)):
                        out.append((file_id, sheet, n, [None if c is None else str(c) for c in row], None))
                        if len(out) >= 10_000:
                            yield pd.DataFrame(out, columns=["file_id", "sheet", "row_index", "cells", "error"])
                            out = []
                except Exception as e:  # a broken file must not end the job
                    out.append((file_id, "", -1, None, f"{type(e).__name__}: {e}"[:500]))
                yield pd.DataFrame(out, columns=["file_id", "sheet", "row_index", "cells", "error"])

    known = files.select("file_id", file_kind(F.col("content"), F.col("name")).alias("kind"), "content")
    key_type = dict(files.dtypes)["file_id"]
    return known.mapInPandas(read, f"file_id {key_type}, sheet string, row_index int, cells array<string>, error string")


def sheet_items(rows: DataFrame) -> DataFrame:
    """Items of rows (file_id, sheet, row_index, cells): the first header among a sheet's first 40 rows names the columns of all rows below.

    Where it names a code but no description, the description is the free column with the longest text on average over the first
    25 filled rows (8 characters or more, filled in a third of them and at least twice, at most 60 % numbers). A sheet without a header has no
    items. Sheets are joined with their header, one row each, so the rows of a sheet stay spread.
    """
    key = ["file_id", "sheet"]
    data = rows.where(F.col("cells").isNotNull()).select(*key, "row_index", "cells")
    tops = data.where(F.col("row_index") < HEADER_ROWS).withColumn("fields", header_fields(F.col("cells"))).where(F.col("fields").isNotNull())
    header = tops.groupBy(*key).agg(F.min_by(F.struct(F.col("row_index").alias("header_row"), "fields"), "row_index").alias("h")).select(*key, "h.header_row", "h.fields")
    below = data.join(header, key).where(F.col("row_index") > F.col("header_row")).where(F.exists("cells", lambda c: c.isNotNull() & (c != "")))
    near = below.where(~F.array_contains(F.array_compact("fields"), "description")).select(*key, "row_index", "cells", "fields")
    sample = _smallest(near, key)
    places = sample.select(*key, F.posexplode("fields").alias("place", "field"), "s").where(F.col("field").isNull())
    values = places.select(*key, "place", F.size("s").alias("n"), F.filter(F.transform("s", lambda r: F.get(r["cells"], F.col("place"))), lambda v: v.isNotNull() & (v != "")).alias("v"))
    figures = F.size(F.filter("v", lambda v: F.replace(v, F.lit("."), F.lit("")).rlike(r"^\d+$")))
    mean = F.aggregate("v", F.lit(0.0), lambda a, v: a + F.length(v)) / F.size("v")
    fit = values.where((F.size("v") >= F.greatest(F.lit(2), F.floor(F.col("n") / 3))) & (figures <= F.size("v") * 0.6)).withColumn("mean", mean).where(F.col("mean") >= 8)
    guess = fit.groupBy(*key).agg(F.max_by("place", F.struct("mean", -F.col("place"))).alias("guessed"))
    named = below.join(guess, key, "left")
    pairs = F.arrays_zip(F.col("fields").alias("f"), F.sequence(F.lit(0), F.size("fields") - 1).alias("i"))

    def field(name: str) -> Column:
        own = F.filter(pairs, lambda p: p["f"] == name)
        at = F.get(own, F.size(own) - 1)["i"]
        if name == "description":
            at = F.coalesce(at, F.col("guessed"))
        return X.clean_text(F.get("cells", at))

    stray = F.get(F.filter(F.transform("cells", lambda c: F.regexp_replace(c, "[^0-9]", "")), lambda c: c.rlike("^[0-9]{10,14}$")), F.lit(0))
    out = named.select(
        *key, "row_index", *[field(f).alias(f) for f in ("sn", "item_no", "description", "uom", "item_group", "itemized")], field("qty").alias("qty_raw"),
        X.only_digits(F.coalesce(field("nupco_code"), stray)).alias("nupco_code"), F.substring(F.to_json("cells"), 1, 4000).alias("raw_row"),
    )
    repeated = header_key(F.col("description")).isin(list(FIELD_OF))
    return out.where((F.length("description") >= 3) & ~repeated).select(
        "*", X.digits_number(F.col("qty_raw")).alias("qty"), classify.item_category(F.col("nupco_code"), F.col("description")).alias("category_guess"),
        X.code_group(F.col("nupco_code")).alias("code_group"), classify.accessory(F.col("description")).alias("is_accessory"),
    )


def _smallest(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key, fields, s): the first 25 filled rows of each sheet; the window's limit is applied before and after the shuffle."""
    first = rows.withColumn("k", F.row_number().over(Window.partitionBy(*key).orderBy("row_index"))).where(F.col("k") <= SNIFF_ROWS)
    return first.groupBy(*key).agg(F.first("fields").alias("fields"), F.collect_list(F.struct("row_index", "cells")).alias("s"))

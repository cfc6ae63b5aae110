"""Scalar cleaners and parsers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidloom.functions.digits import ascii_digits

#: Key range of the second portal: its keys are a pure function of tender number and sequence, above any key of the first.
SECOND_PORTAL = 10**12


def none_if_empty(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def one_line(text: Column) -> Column:
    """Runs of white space (of any script) as one blank, trimmed; '' stays ''."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def clean_text(text: Column) -> Column:
    """one_line, with null for ''."""
    return none_if_empty(one_line(text))


def html_text(html: Column) -> Column:
    """Text of an HTML fragment: tags and breaks become blanks, three entities are resolved; null is ''."""
    bare = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<[^>]+>", " ")
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&quot;", '"')):
        bare = F.replace(bare, F.lit(entity), F.lit(char))
    return one_line(bare)


_DMY = r"([0-9]{1,2})/([0-9]{1,2})/([0-9]{4})"


def dmy_date(text: Column) -> Column:
    """The first day/month/year in a text as a date; null where there is none or it is no date of the calendar."""
    digits = ascii_digits(text)
    part = lambda i: F.regexp_extract(digits, _DMY, i)
    return F.try_to_date(none_if_empty(F.concat_ws("-", *[none_if_empty(part(i)) for i in (3, 2, 1)])), "yyyy-M-d")


def dmy_iso(text: Column) -> Column:
    """dmy_date as ISO text."""
    return dmy_date(text).cast("string")


def dmy_iso_unchecked(text: Column) -> Column:
    """The first day/month/year as year-month-day text, whether it is a date or not."""
    digits = ascii_digits(text)
    part = lambda i: F.regexp_extract(digits, _DMY, i)
    return F.when(digits.rlike(_DMY), F.concat(part(3), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0")))


def digits_number(text: Column) -> Column:
    """The number that all digits and dots of a text spell; signs are lost, two dots make null."""
    return F.regexp_replace(ascii_digits(text), r"[^0-9.]", "").try_cast("double")


def first_number(text: Column) -> Column:
    """The first signed number in a text; commas group, the Arabic decimal sign counts as a dot."""
    found = F.regexp_extract(F.translate(ascii_digits(text), "٫", "."), r"-?[0-9,]*\.?[0-9]+", 0)
    return F.replace(found, F.lit(","), F.lit("")).try_cast("double")


def bracketed(text: Column) -> Column:
    """What stands in the first pair of square brackets, trimmed."""
    return none_if_empty(F.trim(F.regexp_extract(text, r"\[([^\]]*[^\]\s][^\]]*)\]", 1)))


def entity_code(text: Column) -> Column:
    """The digits of a leading `[digits]`."""
    return none_if_empty(F.regexp_extract(text, r"^\s*\[([0-9]+)\]", 1))


def entity_name(text: Column) -> Column:
    """A name without its leading `[digits]`."""
    return none_if_empty(F.trim(F.regexp_replace(text, r"^\s*\[[0-9]+\]", "")))


def drug_code(text: Column) -> Column:
    """A drug code without blanks and dashes."""
    return none_if_empty(F.regexp_replace(text, r"[\s-]", ""))


def only_digits(text: Column) -> Column:
    return none_if_empty(F.regexp_replace(text, "[^0-9]", ""))


def code_group(code: Column) -> Column:
    """The first two digits of a code of ten digits or more."""
    digits = F.regexp_replace(code, "[^0-9]", "")
    return F.when(F.length(digits) >= 10, F.substring(digits, 1, 2))


def portal_key(number: Column, sequence: Column) -> Column:
    """The key of a tender of the second portal."""
    return F.lit(SECOND_PORTAL) + number.cast("bigint") * 100 + F.coalesce(none_if_empty(sequence).cast("bigint"), F.lit(0))


# Fixed value: the shape of a tender id.
_TENDER_ID = r"^\s*([A-Z]{2,4})([0-9]+)[-/]([0-9]{2,4})"


def tender_kind(tender_id: Column) -> Column:
    return none_if_empty(F.regexp_extract(tender_id, _TENDER_ID, 1))


def tender_seq(tender_id: Column) -> Column:
    return none_if_empty(F.regexp_extract(tender_id, _TENDER_ID, 2)).try_cast("int")


def tender_year(tender_id: Column) -> Column:
    """The year of a tender id; two- and three-digit years up to 100 count from 2000."""
    year = none_if_empty(F.regexp_extract(tender_id, _TENDER_ID, 3)).try_cast("int")
    return F.when(year > 100, year).otherwise(year + 2000)


def days_left(day: Column, as_of: str) -> Column:
    """Days from as_of to a date."""
    return F.datediff(day, F.lit(as_of).cast("date"))


def unit_cost(total: Column, quantity: Column) -> Column:
    """total / quantity; null where either is zero or null."""
    return F.when((total != 0) & (quantity != 0), total / quantity)


def compare_key(value: Column) -> Column:
    """A value as it compares between two states: null as '', trimmed, whole decimals as integers."""
    text = F.trim(F.coalesce(value.cast("string"), F.lit("")))
    return F.regexp_replace(text, r"^(-?[0-9]+)\.0+$", "$1")


def status_slugs(label: Column) -> Column:
    """A comma-separated label as slugs: lower case, runs of other characters as one dash."""
    parts = F.filter(F.split(label, ","), lambda p: F.trim(p) != "")
    return F.transform(parts, lambda p: F.regexp_replace(F.regexp_replace(F.lower(F.trim(p)), "[^a-z0-9]+", "-"), "^-+|-+$", ""))


def decoded(url: Column) -> Column:
    """A url with its escapes resolved; '+' stays. Malformed escapes leave the url as it is."""
    return F.coalesce(F.try_url_decode(F.replace(url, F.lit("+"), F.lit("%2B"))), url)


def url_key(url: Column) -> Column:
    """A url as it matches between sources: decoded, without closing slashes, lower case."""
    return F.lower(F.regexp_replace(decoded(url), r"/+\z", ""))


def url_slug(url: Column) -> Column:
    """The decoded last part of a url's path."""
    return decoded(F.substring_index(F.regexp_replace(url, r"/+\z", ""), "/", -1))


def url_file(url: Column) -> Column:
    """The decoded file name in a url's path; null where it has none."""
    path = F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "^[a-zA-Z]+://[^/]*", "")
    return none_if_empty(decoded(F.substring_index(path, "/", -1)))


def file_extension(name: Column) -> Column:
    """The extension of a file name in lower case, without the dot; null where there is none."""
    return none_if_empty(F.lower(F.regexp_extract(name, r"[^.]\.([A-Za-z0-9]+)$", 1)))


def safe_name(text: Column, longest: int = 120) -> Column:
    """A text as part of a path: runs of other characters than word characters, dots and dashes as one underscore."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, r"(?U)[^\w.-]+", "_"), "^_+|_+$", ""), 1, longest)


def percent_encoded(text: Column) -> Column:
    return F.url_encode(F.coalesce(text, F.lit("")))


def detail_url(base: str, **parts: Column) -> Column:
    """A plain link to a tender: base and the parts as encoded parameters, in their order."""
    pairs = [F.concat(F.lit(f"{name}="), percent_encoded(value)) for name, value in parts.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *pairs))


def shown_title(english: Column, arabic: Column) -> Column:
    """The English title, else the Arabic one."""
    return F.coalesce(none_if_empty(english), none_if_empty(arabic))


def content_hash(content: Column) -> Column:
    return F.sha2(content, 256)


def canonical_json_hash(**fields: Column) -> Column:
    """SHA-256 of a record as JSON with its fields in the order of their names, nulls included."""
    return F.sha2(F.to_json(F.struct(*[fields[name].alias(name) for name in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def progress(notes: Column) -> Column:
    """The progress entry of a run's notes; null where they are no JSON."""
    return F.get_json_object(notes, "$.progress")


def table_cell(value: Column, longest: int = 70) -> Column:
    """A value as a cell of a markdown table."""
    return F.substring(F.replace(F.coalesce(none_if_empty(value.cast("string")), F.lit("—")), F.lit("|"), F.lit("\\|")), 1, longest)


def tax_included(header: Column) -> Column:
    """Whether the price column of an items table includes tax: 1, 0, or null where there is no such column."""
    return F.when(header.contains("غير شامل"), 0).when(header.startswith("السعر النهائي"), 1)


def first_currency(total: Column, price: Column) -> Column:
    """The first three capitals in the total, else what the price has in brackets."""
    return F.coalesce(none_if_empty(F.regexp_extract(total, "[A-Z]{3}", 0)), bracketed(price))


def deadline_label(days: Column) -> Column:
    """`closed Nd ago`, `closes today`, `Nd left`, or null."""
    return F.when(days < 0, F.concat(F.lit("closed "), (-days).cast("string"), F.lit("d ago"))).when(days == 0, "closes today").when(days > 0, F.concat(days.cast("string"), F.lit("d left")))

"""Timestamp texts of mixed format, precision and zone as one UTC instant each."""

from __future__ import annotations

import zoneinfo
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bidloom.functions.digits import ascii_digits

MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

#: Zones of clock names that texts use, and of the sources for texts that state none.
NAMED_ZONES = {"riyadh": "Asia/Riyadh", "ksa": "Asia/Riyadh", "amman": "Asia/Amman", "jordan": "Asia/Amman"}
SOURCE_ZONES = {"nupco": "Asia/Riyadh", "joneps": "Asia/Amman"}

_DAY_NAME = r"(?:(?:sat|sun|mon|tue|wed|thu|fri)[a-z]*\.?,?\s+)?"
_CLOCK = (
    r"(?:(?:\s*,\s*|\s+|t)(?<hh>[0-9]{1,2}):(?<mi>[0-9]{2})(?::(?<ss>[0-9]{2})(?:[.,][0-9]+)?)?"
    r"(?:\s*(?<half>am|pm|a\.m\.|p\.m\.|ص|م)(?![a-z]))?)?"
)
_ZONE = (
    r"(?:\s*(?:(?<utc>z|utc|gmt)?(?:(?<sign>[+-])(?<oh>[0-9]{1,2})(?::?(?<om>[0-9]{2}))?)?"
    r"|(?<region>[a-z]+(?:/[a-z0-9_+-]+)+)|\((?<city>[a-z]+) time\)))?"
)
#: Every date format, in one alternation. The day precedes the month unless the year leads.
_DATES = (
    r"(?<d1>[0-9]{1,2})[/.-](?<m1>[0-9]{1,2})[/.-](?<y1>[0-9]{4})",
    r"(?<y2>[0-9]{4})[/.-](?<m2>[0-9]{1,2})[/.-](?<d2>[0-9]{1,2})",
    r"(?<d3>[0-9]{1,2})[\s-]+(?<n3>" + "|".join(MONTHS) + r")[a-z]*\.?,?[\s-]+(?<y3>[0-9]{4})",
)
PATTERN = r"(?is)^\s*(?:(?<unix>[0-9]+)|" + _DAY_NAME + "(?:" + "|".join(_DATES) + ")" + _CLOCK + _ZONE + r")\s*$"
_FIELDS = ("unix", "y", "m", "name", "d", "hh", "mi", "ss", "half", "utc", "sign", "oh", "om", "region", "city")
#: One replacement writes all components, parted by '|'; a group that took no part writes nothing.
_TEMPLATE = "|".join(["${unix}", "${y1}${y2}${y3}", "${m1}${m2}", "${n3}", "${d1}${d2}${d3}", *("${%s}" % f for f in _FIELDS[5:])])


def _zones() -> tuple[str, ...]:
    """Region names of the IANA database that both this Python and a JVM know."""
    names = sorted(z for z in zoneinfo.available_timezones() if "/" in z and not z.startswith(("posix/", "right/", "Etc/", "SystemV/")))
    if not names:
        raise RuntimeError("no time zone database: named regions could not be read")
    return tuple(names)


def days_from_civil(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a Gregorian date, by integer arithmetic; y and m count from March (January and February belong to the year before)."""
    leaps = F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400)
    return (y * 365 + leaps + F.floor((m * 153 + 2) / 5) + d - 719469).cast("long")


def days_in_month(y: Column, m: Column) -> Column:
    leap = (F.pmod(y, F.lit(4)) == 0) & ((F.pmod(y, F.lit(100)) != 0) | (F.pmod(y, F.lit(400)) == 0))
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once. Plain columns would be written out at each use when a filter moves below them."""
    return F.transform(F.array(value), body)[0]


def utc_instant(text: Column, source: Column) -> Column:
    """The instant that text denotes as yyyy-MM-ddTHH:mm:ssZ, or null where it denotes none.

    One regular expression with named groups covers all formats; its groups are taken out once per text. Ranges are checked by the
    calendar, the wall clock is put together with integer day arithmetic, and offsets are subtracted. A named region, or the
    source's own zone where the text states none, follows the IANA history: a time that occurs twice is the earlier instant, a skipped
    one moves forward by the gap. Null, empty or unreadable texts of any length, unknown regions and texts of an unknown source without a
    stated zone give null. Digits alone are Unix time in seconds (up to 11 digits), milliseconds (to 14), microseconds (to 17), nanoseconds (what fits into 64 bits).
    """
    pairs = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    by_name, named, by_source = pairs({z.lower(): z for z in _zones()}), pairs(NAMED_ZONES), pairs(SOURCE_ZONES)

    def components(p: Column) -> Column:
        part = {f: F.nullif(p[i], F.lit("")) for i, f in enumerate(_FIELDS)}
        number = lambda f: F.coalesce(part[f].cast("int"), F.lit(0))
        month = F.coalesce(part["m"].cast("int"), F.array_position(F.array(*map(F.lit, MONTHS)), part["name"]).cast("int"))
        return F.struct(
            part["unix"].alias("unix"), number("y").alias("y"), month.alias("m"), number("d").alias("d"), number("hh").alias("hh"), number("mi").alias("mi"), number("ss").alias("ss"),
            F.substring(part["half"], 1, 1).alias("half"), part["utc"].alias("utc"), part["sign"].alias("sign"), number("oh").alias("oh"), number("om").alias("om"),
            part["region"].alias("region"), part["city"].alias("city"),
        )

    def wall_clock(c: Column) -> Column:
        half = c["half"]
        hour = F.when(half.isNull(), c["hh"]).otherwise(F.pmod(c["hh"], F.lit(12)) + F.when(half.isin("p", "م"), 12).otherwise(0))
        hour_ok = F.when(half.isNull(), c["hh"] <= 23).otherwise(c["hh"].between(1, 12))
        valid = (
            c["m"].between(1, 12) & (c["y"] >= 1) & (c["d"] >= 1) & (c["d"] <= days_in_month(c["y"], c["m"])) & hour_ok
            & (c["mi"] <= 59) & (c["ss"] <= 59) & (c["oh"] <= 18) & (c["om"] <= 59)
        )
        days = days_from_civil(c["y"] - (c["m"] <= 2).cast("int"), F.pmod(c["m"] + 9, F.lit(12)), c["d"])
        wall = F.when(valid, days * 86400 + hour * 3600 + c["mi"] * 60 + c["ss"]).cast("long")
        offset = (c["oh"] * 3600 + c["om"] * 60) * F.when(c["sign"] == "-", -1).otherwise(1)
        own = F.when(c["region"].isNotNull(), by_name[c["region"]]).when(c["city"].isNotNull(), named[c["city"]]).otherwise(by_source[F.lower(source)])
        fixed = (c["utc"].isNotNull() | c["sign"].isNotNull()) & c["region"].isNull() & c["city"].isNull()
        return F.struct(c["unix"].alias("unix"), wall.alias("wall"), offset.alias("offset"), fixed.alias("fixed"), F.when(~fixed, own).alias("zone"))

    def epoch(c: Column) -> Column:
        digits = F.length(c["unix"])
        unit = F.when(digits <= 11, F.lit(1)).when(digits <= 14, F.lit(1_000)).when(digits <= 17, F.lit(1_000_000)).otherwise(F.lit(1_000_000_000))
        in_zone = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(c["wall"]), c["zone"]))
        return F.when(c["unix"].isNotNull(), F.floor(c["unix"].try_cast("long") / unit)).when(c["fixed"], c["wall"] - c["offset"]).otherwise(in_zone).cast("long")

    def stamp(s: Column) -> Column:
        rest = F.pmod(s, F.lit(86400))
        clock = F.format_string("%02d:%02d:%02d", F.floor(rest / 3600), F.floor(F.pmod(rest, F.lit(3600)) / 60), F.pmod(rest, F.lit(60)))
        day = F.date_from_unix_date(F.floor(s / 86400).cast("int")).cast("string")
        return F.when(s.isNotNull(), F.concat(day, F.lit("T"), clock, F.lit("Z")))

    def matched(clean: Column) -> Column:
        return F.struct(clean.alias("was"), F.regexp_replace(clean, PATTERN, _TEMPLATE).alias("now"))

    def read(c: Column) -> Column:
        # A text that matches becomes another one, with its parts between bars; any other text stays.
        return F.when(c["was"] != c["now"], F.split(c["now"], r"\|"))

    clean = F.lower(F.trim(ascii_digits(text)))
    return _let(_let(_let(_let(_let(_let(clean, matched), read), components), wall_clock), epoch), stamp)


def field_instants(tenders: DataFrame, fields: tuple[str, ...] = ("opening_date", "submission_deadline", "bid_opening")) -> DataFrame:
    """Rows (post_id, field, instant_utc) for every field text that denotes an instant.

    Null and unreadable texts give no row, nor does an empty table; a row that comes twice gives its instants twice. Columns of
    other names change nothing.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields]))
    texts = tenders.select("post_id", "source", pairs.alias("f")).select("post_id", "source", "f.field", "f.text").where(F.col("text").isNotNull())
    return texts.select("post_id", "field", utc_instant(F.col("text"), F.col("source")).alias("instant_utc")).where(F.col("instant_utc").isNotNull())

"""Quantities recorded in different units, packs and scales, in the common unit of their kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bidloom.functions.digits import ascii_digits

#: Spelling -> (kind, base unit, factor). Kinds: measure (of the base unit), count (pieces), times (a number of pieces as a unit), scale (a factor only), pack (a container).
ALIASES: dict[str, tuple[str, str | None, int]] = {
    **{a: ("measure", "ml", 1) for a in ("ML", "MILLILITRE", "MILLILITER", "CC", "مل")},
    **{a: ("measure", "ml", 10) for a in ("CL",)},
    **{a: ("measure", "ml", 1000) for a in ("L", "LTR", "LTRS", "LITRE", "LITER", "LITRES", "LITERS", "لتر")},
    **{a: ("measure", "mm", 1) for a in ("MM", "ملم", "مم")},
    **{a: ("measure", "mm", 10) for a in ("CM", "سم")},
    **{a: ("measure", "mm", 1000) for a in ("M", "MTR", "MTRS", "METER", "METRE", "METERS", "METRES", "متر")},
    **{a: ("measure", "mg", 1) for a in ("MG", "ملغ", "ملجم", "مجم")},
    **{a: ("measure", "mg", 1000) for a in ("G", "GM", "GMS", "GRAM", "GRAMS", "غم", "جم", "غرام", "جرام")},
    **{a: ("measure", "mg", 1_000_000) for a in ("KG", "KGS", "KILOGRAM", "KILOGRAMS", "كغم", "كجم", "كغ")},
    **{a: ("count", "each", 1) for a in ("EA", "EACH", "UNIT", "UNITS", "NOS", "NO", "PIECE", "PIECES", "PCS", "PC", "S", "حبة", "قطعة", "وحدة")},
    **{a: ("times", "each", 2) for a in ("PAIR", "PAIRS", "PR", "PRS", "زوج")},
    **{a: ("times", "each", 12) for a in ("DOZEN", "DOZENS", "DOZ", "DZ", "درزن", "دزينة")},
    **{a: ("times", "each", 100) for a in ("HUNDRED", "HUNDREDS", "مئة", "مائة")},
    **{a: ("times", "each", 144) for a in ("GROSS",)},
    **{a: ("times", "each", 1000) for a in ("THOUSAND", "THOUSANDS", "THOUS", "K", "الف", "ألف")},
    **{a: ("times", "each", 1_000_000) for a in ("MILLION", "MILLIONS", "MIO", "مليون")},
}

#: A number: digits, then groups behind one separator each. Blanks, apostrophes and Arabic marks part groups of three only.
_NUMBER = r"[0-9]+(?:[.,٫][0-9]+|[٬    '’][0-9]{3}(?![0-9]))*"
_WORD = r"(?<!\p{L})(?:%s)(?!\p{L})"


def unit_table(spark: SparkSession) -> DataFrame:
    """The alias table: about sixty fixed rows."""
    rows = [(alias, kind, base, factor) for alias, (kind, base, factor) in ALIASES.items()]
    return spark.createDataFrame(rows, "alias string, kind string, base string, factor long")


def plain_number(text: Column, dot_groups: Column) -> Column:
    """The number that text states, as a decimal; null where it states none.

    A separator other than a dot before exactly three digits groups thousands, otherwise it is the decimal sign. A dot before exactly
    three digits groups thousands only where dot_groups is true.
    """
    grouped = F.regexp_replace(text, r"[^0-9.](?=[0-9]{3}(?![0-9]))", "")
    grouped = F.when(dot_groups, F.regexp_replace(grouped, r"\.(?=[0-9]{3}(?![0-9]))", "")).otherwise(grouped)
    return F.regexp_replace(grouped, r"[^0-9.]", ".").try_cast("decimal(28,9)")


def _upper(text: Column) -> Column:
    return F.upper(ascii_digits(text))


def _phrase(text: Column, dot_groups: Column) -> dict[str, Column]:
    """The pieces of a unit phrase (`BOX OF 10`, `2.5 LTR BAG`, `100'S`, `K`): content number, unit word, multiple word."""
    words = {kind: "|".join(sorted((a for a, v in ALIASES.items() if v[0] in kind), key=len, reverse=True)) for kind in (("measure", "count"), ("times",))}
    some = lambda kind: F.nullif(F.regexp_extract(text, _WORD % words[kind], 0), F.lit(""))
    return {"content": plain_number(F.nullif(F.regexp_extract(text, _NUMBER, 0), F.lit("")), dot_groups), "unit": some(("measure", "count")), "times": some(("times",))}


def common_amounts(items: DataFrame, key: str = "id", text: str = "qty_raw", unit: str = "uom", dot_groups: Column | None = None) -> DataFrame:
    """Adds base_unit (each, mg, ml, mm) and base_amount (decimal) to every row; both null where `text` states no number; an amount
    beyond 20 digits is null.

    amount = the leading number x the multiple words (dozen, thousand) x the unit. The unit is what the text itself names behind the
    number (a measure, pieces, or a pack with its content); else what the unit field names; else each. A pack with stated content
    counts as that content, one without as 1 each. A multiple named in both the text and the unit field counts once. Words that are
    no known unit are packs. Spellings are looked up by a join with the fixed alias table (about sixty rows, broadcast).
    """
    spark = items.sparkSession
    dots = F.lit(False) if dot_groups is None else F.coalesce(dot_groups, F.lit(False))
    q, u = _upper(F.col(text)), _upper(F.col(unit))
    number = F.nullif(F.regexp_extract(q, _NUMBER, 0), F.lit(""))
    behind = F.regexp_extract(q, r"(?s)^[^0-9]*" + _NUMBER + r"(.*)\z", 1)
    keep = items.columns
    df = items.withColumns({"_n": plain_number(number, dots), "_dots": dots, "_behind": behind, "_u": u})
    for side, source in (("q", "_behind"), ("u", "_u")):
        df = df.withColumns({f"_{side}_{k}": v for k, v in _phrase(F.col(source), F.col("_dots")).items()})
    # An empty side names nothing; such rows carry no key that could gather in one place, since the table is broadcast.
    aliases = unit_table(spark)
    for name in ("_q_unit", "_u_unit", "_q_times", "_u_times"):
        own = aliases.select(F.col("alias").alias(name), F.col("base").alias(f"{name}_base"), F.col("factor").alias(f"{name}_factor"))
        df = df.join(F.broadcast(own), name, "left")
    c = F.col
    one = F.lit(1).cast("decimal(28,9)")
    named = c("_q_unit").isNotNull() | c("_q_content").isNotNull()
    unit_base = F.coalesce(c("_q_unit_base"), F.when(c("_q_content").isNotNull() | ~named, c("_u_unit_base")), F.lit("each"))
    own_factor = F.coalesce(c("_q_unit_factor"), F.when(c("_q_content").isNotNull(), c("_u_unit_factor")), F.lit(1)) * F.coalesce(c("_q_content"), one)
    field_times = F.when(c("_u_times").isNotNull() & ~c("_u_times_factor").eqNullSafe(c("_q_times_factor")), c("_u_times_factor")).otherwise(F.lit(1))
    field_factor = F.coalesce(c("_u_unit_factor"), F.lit(1)) * F.coalesce(c("_u_content"), one) * field_times
    factor = F.coalesce(c("_q_times_factor"), F.lit(1)) * F.when(named, own_factor).otherwise(field_factor)
    amount = F.try_multiply(c("_n").try_cast("decimal(20,6)"), factor.try_cast("decimal(17,6)"))
    return df.select(*keep, F.when(c("_n").isNotNull(), unit_base).alias("base_unit"), amount.alias("base_amount"))


def converted_items(items: DataFrame, second_portal_from: int = 10**12) -> DataFrame:
    """Rows (item_id, base_unit, base_qty) of items whose amount in the common unit differs from qty, or whose qty is null.

    Tenders of the second portal have keys from 10^12 on, those of the first never do; only there a dot may group thousands.
    Redelivered rows count once: rows with equal results of one id collapse on the map side. Null units mean each; rows with a null id or
    qty_raw, with texts that state no number, and empty tables give nothing. Texts of any length are read whole.
    """
    rows = items.select("id", "uom", "qty_raw", "qty", "post_id").where(F.col("qty_raw").isNotNull() & F.col("id").isNotNull())
    done = common_amounts(rows, dot_groups=F.col("post_id") >= second_portal_from).where(F.col("base_amount").isNotNull())
    differs = F.col("qty").isNull() | (F.col("base_amount").cast("double") != F.col("qty"))
    return done.where(differs).select(F.col("id").alias("item_id"), "base_unit", F.col("base_amount").try_cast("long").alias("base_qty")).dropDuplicates()

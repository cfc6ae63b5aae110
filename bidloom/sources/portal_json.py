"""Nested drug lines of the second portal."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bidloom.functions import scalars as X
from bidloom.functions.classify import GROUPS

PAYLOAD = (
    "total int, list array<struct<lotSerno string, itemSerno string, clId string, clNmAr string, clNmEn string, rdlItemCd string, rdlGenerNm string, unitMesurNm string, "
    "whoutTaxQty double, whTaxQty double, totlQty double, totlQtyStr string, details array<struct<deNo string, abbrNm string, totlQty double>>>>"
)


def drug_lines(payloads: DataFrame, key: str = "post_id", payload: str = "payload") -> DataFrame:
    """One row per drug line: (key, row_index, sn, item_no, description, generic names, rdl_code, unspsc, uom, qty, qty_raw, code_group, category_guess, demand).

    demand holds the entities with a quantity other than zero. Texts that are no such JSON, and nulls, give no lines.
    """
    lines = payloads.select(key, F.posexplode(F.from_json(payload, PAYLOAD)["list"]).alias("n", "l"))
    name = lambda f: X.none_if_empty(F.col(f"l.{f}"))
    unspsc = X.none_if_empty(F.trim(F.col("l.clId")))
    group = F.when(F.length(unspsc) >= 2, F.substring(unspsc, 1, 2))
    wanted = F.filter(F.col("l.details"), lambda d: F.coalesce(d["totlQty"], F.lit(0.0)) != 0)
    demand = F.transform(wanted, lambda d: F.struct(d["deNo"].alias("entity"), d["abbrNm"].alias("abbr"), d["totlQty"].alias("qty")))
    categories = F.create_map(*[F.lit(x) for kv in GROUPS.items() for x in kv])
    return lines.select(
        key, (F.col("n") + 1).alias("row_index"), F.coalesce(F.col("l.lotSerno"), F.lit("")).alias("sn"), F.coalesce(name("itemSerno"), (F.col("n") + 1).cast("string")).alias("item_no"),
        F.coalesce(name("rdlGenerNm"), name("clNmEn"), name("clNmAr")).alias("description"), F.col("l.clNmEn").alias("generic_name"), F.col("l.clNmAr").alias("generic_name_ar"),
        X.drug_code(F.col("l.rdlItemCd")).alias("rdl_code"), unspsc.alias("unspsc"), F.col("l.unitMesurNm").alias("uom"), F.col("l.totlQty").alias("qty"), F.col("l.totlQtyStr").alias("qty_raw"),
        group.alias("code_group"), F.coalesce(categories[group], F.lit("pharma")).alias("category_guess"), F.when(F.size(demand) > 0, demand).alias("demand"),
    )


def demand_rows(items: DataFrame, key: str = "id", column: str = "demand_json") -> DataFrame:
    """(key, position, entity, abbr, qty): stored demand lists as rows."""
    parsed = F.from_json(column, "array<struct<entity string, abbr string, qty double>>")
    return items.select(key, F.posexplode(parsed).alias("position", "d")).select(key, "position", "d.entity", "d.abbr", "d.qty")

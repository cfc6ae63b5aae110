"""Categories of tenders and items, from words and code groups."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bidloom.functions.scalars import code_group

# By category, in the order in which they are tried, the beginnings of words and the Arabic words that name it.
STEMS: dict[str, tuple[str, ...]] = {
    "dental": (
        "dental", "dentist", "endodont", "orthodont", "periodont", "prosthodont", "amalgam", "composite resin", "gutta.?percha", "k.?file",
    ),
    "pharma": (
        "drug", "pharmac", "medicin", "tablet", "capsule", "injection", "vial", "ampoule", "syrup", "suspension", "insulin", "vaccine", "antibiot", "antisept",
        "antifung", "antivir", "anesthet", "anaesthet", "analges", "oncolog", "chemotherap", "infusion", "heparin", "saline", "dextrose", "sodium chloride",
        "ointment", "suppositor", "inhaler", "eye drop", "iv fluid",
    ),
    "lab": (
        "laborator", "reagent", "assay", "pcr", "elisa", "centrifuge", "analyz", "analys", "microbiolog", "histopath", "specimen", "diagnostic", "test kit",
        "culture medium", "pipette", "cuvette",
    ),
    "device": (
        "device", "equipment", "instrument", "surgical", "endoscop", "stent", "catheter", "implant", "monitor", "ventilator", "imaging", "radiolog", "ultrasound",
        "mri", "ct scan", "disposable", "consumable", "supplies", "prosthe", "syringe", "needle", "glove", "suture", "dressing", "bandage",
    ),
    "service": (
        "service", "maintenance", "installation", "fit.?out", "construction", "training", "consultanc", "logistic", "warehous", "transport", "delivery cost",
        "warranty cost",
    ),
}
ARABIC: dict[str, tuple[str, ...]] = {
    "dental": ("الأسنان", "أسنان"),
    "pharma": ("دواء", "أدوية", "دوائية", "لقاح", "مستحضرات"),
    "lab": ("مختبر", "مختبرات", "تحاليل"),
    "device": ("أجهزة", "جهاز", "مستلزمات", "جراح"),
    "service": ("خدمات", "صيانة", "تشغيل", "توريد وتركيب"),
}

# Category of a code group.
GROUPS = {
    "51": "pharma", "41": "lab", "45": "lab", "42": "device", "40": "equipment", "46": "consumable",
    "43": "other", "44": "other", "47": "other", "48": "other", "49": "other", "50": "other", "53": "other",
}

# Phrases of accessory lines.
ACCESSORY = ("related to", "warranty cost", "delivery cost", "installation cost", "training cost", "spare part")


def category_pattern(category: str) -> str:
    """One pattern per category. The start of a word is written out, so that it means the same in every engine."""
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(STEMS[category]) + ")|" + "|".join(ARABIC[category])


def word_category(*texts: Column) -> Column:
    """The first category that a word of the texts names, else other."""
    blob = F.lower(F.concat_ws(" ", *texts))
    out = F.lit("other")
    for category in reversed(STEMS):
        out = F.when(blob.rlike(category_pattern(category)), category).otherwise(out)
    return out


def item_category(code: Column, description: Column) -> Column:
    """The category of an item: its code group's, but for services, and where words are more specific than the group."""
    word = word_category(description)
    group = F.create_map(*[F.lit(x) for kv in GROUPS.items() for x in kv])[code_group(code)]
    words_win = (word == "service") | group.isNull() | ((group == "device") & word.isin("dental", "pharma")) | ((group == "lab") & (word == "dental"))
    return F.when(words_win, word).otherwise(group)


def accessory(description: Column) -> Column:
    """1 for accessory lines (delivery, warranty, spare parts and the like), else 0."""
    return F.coalesce(F.lower(description).rlike("|".join(ACCESSORY)), F.lit(False)).cast("int")

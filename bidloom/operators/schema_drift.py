"""Files whose field labels and JSON types drift: one consistent table and a log of every change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bidloom.session import cut

#: The item columns that a label may fill, by their value.
FIELDS = ("sn", "nupco_code", "description", "uom", "qty_raw")

#: Bits of JSON types.
TYPE_BITS = {"STRING": 1, "NUMBER": 2, "BOOLEAN": 4, "ARRAY": 8, "OBJECT": 16}

#: Files of one feed that a window holds at most.
SLICE = 1000


def normal_label(label: Column) -> Column:
    """Lower case, every run of other characters than a-z and 0-9 as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.lower(label), "[^a-z0-9]+", " "))


def type_bit(value: Column) -> Column:
    """The bit of a variant's JSON type; 0 for null."""
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    kind = F.when(name.isin("BIGINT", "DECIMAL", "DOUBLE", "FLOAT"), "NUMBER").otherwise(name)
    bit = F.lit(0)
    for known, number in TYPE_BITS.items():
        bit = F.when(kind == known, number).otherwise(bit)
    return bit


def value_text(value: Column) -> Column:
    """A variant as text: nested values hold the same text, parts join with a blank."""
    deep = F.array_join(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda v: _flat(v)), " ")
    wide = F.array_join(F.transform(F.map_values(F.try_variant_get(value, "$", "map<string,variant>")), lambda v: _flat(v)), " ")
    name = F.schema_of_variant(value)
    return F.when(name.startswith("ARRAY"), deep).when(name.startswith("OBJECT"), wide).otherwise(F.try_variant_get(value, "$", "string"))


def _flat(value: Column) -> Column:
    inner = F.coalesce(F.try_variant_get(value, "$", "array<string>"), F.map_values(F.try_variant_get(value, "$", "map<string,string>")))
    return F.coalesce(F.try_variant_get(value, "$", "string"), F.array_join(inner, " "))


def raw_entries(items: DataFrame, *keep: str) -> DataFrame:
    """One row per label of every parseable raw_row: keep, label (normalised), value (variant). Cut-off texts and non-objects give none."""
    parsed = F.from_json("raw_row", "map<string,variant>")
    return items.where(F.col("attachment_id").isNotNull()).select(*keep, F.explode(parsed).alias("key", "value")).select(*keep, normal_label(F.col("key")).alias("label"), "value")


def as_number(text: Column) -> Column:
    """Null where the text is no number."""
    return text.try_cast("decimal(38,10)")


def as_flag(text: Column) -> Column:
    """Null where the text is neither true nor false."""
    return F.when(F.lower(text) == "true", True).when(F.lower(text) == "false", False)


def label_catalogue(items: DataFrame, casts: bool = False) -> DataFrame:
    """One row per file and label: types (bits), filled (non-null values) and, per item column, how many values equal it.

    With casts also numbers and flags, how many values read as a number, as true or false.
    Rows combine on the map side, so a file or label that holds a third of all rows costs no more than others.
    """
    rows = raw_entries(items.select("attachment_id", *FIELDS, "raw_row"), "attachment_id", *FIELDS)
    valued = rows.select("attachment_id", "label", *FIELDS, type_bit(F.col("value")).alias("bit"), value_text(F.col("value")).alias("text"))
    digits = F.regexp_replace("text", "[^0-9]", "")
    same = {f: F.col(f) == (digits if f == "nupco_code" else F.col("text")) for f in FIELDS}
    return valued.groupBy("attachment_id", "label").agg(
        F.bit_or("bit").alias("types"),
        F.sum((F.col("bit") > 0).cast("long")).alias("filled"),
        *[F.sum(F.coalesce(same[f], F.lit(False)).cast("long")).alias(f"is_{f}") for f in FIELDS],
        *([F.count(as_number(F.col("text"))).alias("numbers"), F.count(as_flag(F.col("text"))).alias("flags")] if casts else []),
    )


def alias_table(catalogue: DataFrame) -> DataFrame:
    """label -> field: the item column that the label's values equal in more than half of all its rows, over all files. One row per such label."""
    sums = catalogue.groupBy("label").agg(F.sum("filled").alias("filled"), *[F.sum(f"is_{f}").alias(f"is_{f}") for f in FIELDS])
    best = F.greatest(*[F.struct(F.col(f"is_{f}").alias("n"), F.lit(f).alias("field")) for f in FIELDS])
    return sums.select("label", "filled", best.alias("b")).where(F.col("b.n") * 2 > F.col("filled")).select("label", F.col("b.field").alias("field"))


def label_types(catalogue: DataFrame) -> DataFrame:
    """(label, field, kind): the item column of a label as in the alias table, else null, and the type that more than half of the filled values
    of its field read as, over all its labels: number, flag or text. For a catalogue with casts."""
    sums = catalogue.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("filled", "numbers", "flags", *[f"is_{f}" for f in FIELDS])])
    best = F.greatest(*[F.struct(F.col(f"is_{f}").alias("n"), F.lit(f).alias("field")) for f in FIELDS])
    named = sums.withColumn("b", best).withColumn("field", F.when(F.col("b.n") * 2 > F.col("filled"), F.col("b.field")))
    total = lambda c: F.sum(c).over(Window.partitionBy("field", F.when(F.col("field").isNull(), F.col("label"))))
    kind = F.when(total("numbers") * 2 > total("filled"), "number").when(total("flags") * 2 > total("filled"), "flag").otherwise("text")
    return named.select("label", "field", kind.alias("kind"))


def label_lifespans(items: DataFrame, files: DataFrame, catalogue: DataFrame | None = None) -> DataFrame:
    """The column catalogue by feed and file: (feed, file_no, field_key, label, types). field_key is the item column or the label itself.

    Where two labels of one file fill one field, the alphabetically first stands for it.
    """
    # The catalogue is read twice, with other columns each time; written once, the raw rows are parsed once.
    catalogue = cut(label_catalogue(items)) if catalogue is None else catalogue
    own = files.where(F.col("feed").isNotNull() & F.col("file_no").isNotNull()).select("attachment_id", "feed", "file_no")
    named = catalogue.select("attachment_id", "label", "types").join(alias_table(catalogue), "label", "left")
    keyed = named.withColumn("field_key", F.coalesce(F.col("field"), F.concat(F.lit("label "), F.col("label"))))
    return keyed.join(own, "attachment_id").groupBy("feed", "field_key", "file_no").agg(F.min("label").alias("label"), F.bit_or("types").alias("types"))


def label_changes(items: DataFrame, files: DataFrame) -> DataFrame:
    """Rows (attachment_id, change_kind, label): labels added, removed, renamed or retyped from each file of a feed to the next.

    Islands of consecutive files are found per feed and field with lag and lead: an island's start is an addition (but in a feed's
    first file), the file after its end a removal; inside an island the label and the types are compared with the file before.
    Files whose values are all null on one side show no change of type. A feed is cut into slices of 1000 files, each with the file
    before it, so a feed of any length stays in bounded windows. A file without a parseable row has no labels; a null, cut-off or non-object
    raw_row gives none. Files without feed, number or entry in `files` count for nothing. Repeated rows and columns of other names change
    nothing; empty tables give an empty result.
    """
    spans = label_lifespans(items, files)
    at = F.floor(F.col("file_no") / SLICE).cast("long")
    last = F.pmod("file_no", F.lit(SLICE)) == SLICE - 1
    # The last file of a slice also opens the next one: there its end is looked at, here its start.
    homes = F.when(last, F.array(F.struct(at.alias("no"), F.lit(False).alias("halo")), F.struct((at + 1).alias("no"), F.lit(True).alias("halo")))).otherwise(
        F.array(F.struct(at.alias("no"), F.lit(False).alias("halo"))),
    )
    rows = spans.withColumn("home", F.explode(homes)).select("feed", "field_key", "file_no", "label", "types", "home.no", "home.halo")
    order = Window.partitionBy("feed", "field_key", "no").orderBy("file_no")
    rows = rows.select(
        "*", F.lag("file_no").over(order).alias("before"), F.lag("label").over(order).alias("label_before"), F.lag("types").over(order).alias("types_before"), F.lead("file_no").over(order).alias("after"),
    )
    joined = F.coalesce(F.col("before") == F.col("file_no") - 1, F.lit(False))
    begins = ~F.col("halo") & ~joined & (F.col("file_no") > 1)
    renamed = ~F.col("halo") & joined & (F.col("label") != F.col("label_before"))
    retyped = ~F.col("halo") & joined & (F.col("types") != F.col("types_before")) & (F.col("types") > 0) & (F.col("types_before") > 0)
    ends = (F.col("halo") | (F.pmod("file_no", F.lit(SLICE)) != SLICE - 1)) & ~F.coalesce(F.col("after") == F.col("file_no") + 1, F.lit(False))
    event = lambda when, kind, no: F.when(when, F.struct(no.alias("file_no"), F.lit(kind).alias("change_kind")))
    here, following = F.col("file_no"), F.col("file_no") + 1
    events = F.filter(
        F.array(event(begins, "added", here), event(renamed, "renamed", here), event(retyped, "retyped", here), event(ends, "removed", following)), lambda e: e.isNotNull(),
    )
    log = rows.select("feed", "label", F.explode(events).alias("e")).select("feed", "e.file_no", "e.change_kind", "label")
    own = files.select("feed", "file_no", "attachment_id")
    return log.join(own, ["feed", "file_no"]).select("attachment_id", "change_kind", "label")


def _by_key(entries: Column, value: str) -> Column:
    """A map of an array of structs: key -> greatest value, without the entries whose value is null."""
    filled = F.filter(entries, lambda e: e[value].isNotNull())
    keys = F.array_distinct(F.transform(filled, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.array_max(F.transform(F.filter(filled, lambda e: e["key"] == k), lambda e: e[value]))))


def consistent_items(items: DataFrame) -> DataFrame:
    """One table of all files: (id, attachment_id, sn, nupco_code, description, uom, qty_raw, others, numbers, flags, parsed), read from raw_row under
    any label.

    The five fields are taken out by the alias table, as text; codes keep their digits only. others holds every other label with its
    texts (none for null): a label without alias, a code without digits, and what a second label or a redelivered row says otherwise of a
    field, of which the greatest text stands. Labels are normalised; one without any of a-z and 0-9 stands as it is. numbers and flags hold the
    values of the fields, by column or label, that the catalogue shows as numbers or as true and false (see label_types), as far as they can be
    cast; the text stays in any case. parsed is false where raw_row is cut off or null; such rows have null fields and empty maps. Rows without id
    are left out, redelivered rows count once.
    """
    own = items.where(F.col("id").isNotNull()).select("id", "attachment_id", *FIELDS, "raw_row")
    types = label_types(label_catalogue(own, casts=True))
    raw = own.select("id", "attachment_id", F.from_json("raw_row", "map<string,variant>").alias("raw"))
    entries = raw.select("id", "attachment_id", F.col("raw").isNotNull().alias("parsed"), F.explode_outer("raw").alias("name", "value"))
    texts = entries.select("id", "attachment_id", "parsed", "name", normal_label(F.col("name")).alias("label"), value_text(F.col("value")).alias("text")).join(types, "label", "left")
    value = F.when(F.col("field") == "nupco_code", F.nullif(F.regexp_replace("text", "[^0-9]", ""), F.lit(""))).otherwise(F.col("text"))
    shown = F.when(F.col("label") == "", F.trim("name")).otherwise(F.col("label"))
    texts = texts.withColumns({"value": value, "shown": shown})
    number, flag = F.when(F.col("kind") == "number", as_number(F.col("value"))), F.when(F.col("kind") == "flag", as_flag(F.col("value")))
    entry = F.struct(F.col("shown").alias("label"), F.coalesce("field", "shown").alias("key"), "field", "text", "value", number.alias("number"), flag.alias("flag"))
    wide = texts.groupBy("id").agg(
        F.max("attachment_id").alias("attachment_id"), F.max("parsed").alias("parsed"), *[F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in FIELDS],
        F.array_sort(F.collect_set(F.when(F.col("name").isNotNull(), entry))).alias("entries"),
    )
    stands = lambda e: F.coalesce(*[F.when(e["field"] == f, e["value"] == F.col(f)) for f in FIELDS], F.lit(False))
    rest = F.filter("entries", lambda e: e["field"].isNull() | (e["text"].isNotNull() & ~stands(e)))
    valued = F.filter("entries", lambda e: e["field"].isNull() | stands(e))
    wide = wide.withColumns({"rest": rest, "valued": valued})
    labels = F.array_distinct(F.transform("rest", lambda e: e["label"]))
    others = F.map_from_arrays(labels, F.transform(labels, lambda k: F.array_distinct(F.transform(F.filter("rest", lambda e: (e["label"] == k) & e["text"].isNotNull()), lambda e: e["text"]))))
    maps = (others.alias("others"), _by_key(F.col("valued"), "number").alias("numbers"), _by_key(F.col("valued"), "flag").alias("flags"))
    return wide.select("id", "attachment_id", *FIELDS, *maps, "parsed")

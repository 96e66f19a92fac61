"""Nested listing items -> typed listing rows (a whole-table job; no per-row Python).

item JSON text --from_json--> struct --flatten--> columns; the ``params`` array is read with
higher-order functions: for each wanted key the *last* matching element wins (``filter`` then
``try_element_at(-1)``), price comes from the last price-kind element, generic elements give their
label (or, when the label is empty, their own key). Labels are then decoded by the native label
expressions. Malformed JSON yields a null struct: those rows are split off and counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import bool_label, floor, leading_number, market, price_per_m, rooms
from ..schemas import ITEM_SCHEMA, RAW_COLUMNS
from .dedup import dedup_last

CORRUPT = "_corrupt_record"
PRICE_KIND, GENERIC_KIND = "PriceParam", "GenericParam"
# Param keys of the listing source and the typed column each one feeds.
PARAM_KEYS = ("m", "rent", "price_per_m", "rooms", "floor_select", "furniture", "market", "builttype")


def parse_items(df: DataFrame, text_col: str = "item_json") -> DataFrame:
    """Add ``item`` (struct) and ``bad_item``: text that is no JSON object, or whose nested parts have another shape.

    The text is parsed once a row: the generator keeps the optimiser from parsing it anew for each field that is read.
    An object without any of the fields is an item of nulls.
    """
    schema = T.StructType([*ITEM_SCHEMA.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(text_col), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    out = df.select("*", F.explode(F.array(parsed)).alias("item"))
    bad = F.col("item").isNull() | F.col(f"item.{CORRUPT}").isNotNull() | ~F.col(text_col).rlike(r"^\s*\{")
    return out.withColumn("bad_item", F.coalesce(bad, F.lit(True)))


def split_malformed(df: DataFrame, text_col: str = "item_json") -> tuple[DataFrame, DataFrame]:
    """(parsed rows, malformed rows)."""
    parsed = parse_items(df, text_col)
    return parsed.filter(~F.col("bad_item")).drop("bad_item"), parsed.filter("bad_item").drop("bad_item", "item")


def malformed_counts(df: DataFrame, keys: Sequence[str], text_col: str = "item_json") -> DataFrame:
    """Items and skipped (malformed) items per batch."""
    return parse_items(df, text_col).groupBy(*keys).agg(F.count(F.lit(1)).alias("items"), F.count_if("bad_item").alias("malformed"))


def flatten_items(df: DataFrame) -> DataFrame:
    """Null-safe struct access: item.* -> top-level columns (params kept for the next step)."""
    i = "item"
    return df.select(
        *[c for c in df.columns if c not in (i, "item_json")],
        F.col(f"{i}.id").alias("id"), F.col(f"{i}.url").alias("url"), F.col(f"{i}.title").alias("title"),
        F.col(f"{i}.created_time").alias("created_time"),
        F.col(f"{i}.location.city.name").alias("city"),
        F.col(f"{i}.location.district.name").alias("district"),
        F.col(f"{i}.map.lat").alias("latitude"), F.col(f"{i}.map.lon").alias("longitude"),
        F.col(f"{i}.params").alias("params"),
    )


def params_to_columns(df: DataFrame, keys: Sequence[str] = PARAM_KEYS) -> DataFrame:
    """``params`` -> price, currency and one text column per generic key (last occurrence wins).

    Elements are told apart once a row; a key's last one is then found by its place in the reversed array.
    """
    kept = [c for c in df.columns if c != "params"]
    last_price = F.try_element_at(F.filter("params", lambda x: x["value"]["__typename"] == PRICE_KIND), F.lit(-1))
    out = df.select(*kept, last_price["value"].alias("_price"), F.reverse(F.filter("params", lambda x: x["value"]["__typename"] == GENERIC_KIND)).alias("_generic"))
    out = out.select(*kept, "_price", "_generic", *[F.array_position("_generic.key", k).alias(f"_at_{k}") for k in keys])

    def text(k: str) -> Column:
        label, own = (F.get(f"_generic.value.{x}", (F.col(f"_at_{k}") - 1).cast("int")) for x in ("label", "key"))
        return F.coalesce(F.when(label != "", label), own)

    return out.select(*kept, F.col("_price.value").alias("price"), F.col("_price.currency").alias("currency"), *[text(k).alias(k) for k in keys])


def type_columns(df: DataFrame) -> DataFrame:
    """Decode the label columns into the typed listing columns; drop the labels."""
    r, f = rooms(F.col("rooms")), floor(F.col("floor_select"))
    out = df.select(
        "*",
        leading_number(F.col("m")).alias("area_sqm"),
        leading_number(F.col("rent")).alias("extra_rent_pln"),
        r["num_rooms"].alias("num_rooms"), r["rooms_capped"].alias("rooms_capped"),
        f["floor"].alias("floor"), f["floor_capped"].alias("floor_capped"),
        bool_label(F.col("furniture")).alias("is_furnished"),
        F.col("builttype").alias("building_type"),
        market(F.col("market")).alias("market_type"),
        price_per_m(F.col("price_per_m")).alias("price_per_sqm_listed"),
    )
    return out.drop(*PARAM_KEYS)


def stamp(df: DataFrame, collected_at) -> DataFrame:
    """Collection time as a UTC wall-clock timestamp (a run argument, so runs are reproducible)."""
    return df.withColumn("date_collected", F.lit(collected_at).cast("timestamp_ntz"))


def to_raw_schema(df: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Project to the raw table's 22 columns (unknown extras dropped), plus any ``extra`` columns."""
    return df.select(*RAW_COLUMNS, *extra)


def normalize(items: DataFrame, collected_at, keys: Sequence[str] = ("source_city", "batch_date"),
              seq: str = "seq", text_col: str = "item_json") -> DataFrame:
    """items (keys, seq, item_json) -> typed raw rows, malformed items skipped, last duplicate id wins.

    Labels are decoded behind the dedup: together with the reading of ``params`` they make one generated method that is too
    large for the JVM to compile.
    """
    good, _ = split_malformed(items, text_col)
    deduped = dedup_last(params_to_columns(flatten_items(good)), [*keys, "id"], seq)
    typed = stamp(type_columns(deduped), collected_at)
    return to_raw_schema(typed, extra=[k for k in keys if k != "source_city"] + [seq])

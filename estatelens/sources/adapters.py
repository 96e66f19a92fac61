"""Adapters: the driver's synthetic tables played as listing-pipeline inputs.

Every registered query starts here, so its work grows with the given tables.

* ``raw_from_events``   -- a user is a listing, an event is one scrape (raw listing table)
* ``lookup_from_nations`` -- the city seed derived from nation x region (some nations left unmapped)
* ``gate_batches_from_events`` -- typed city batches with planted defects for the quality gate
* ``items_from_events`` -- nested listing items (JSON text) for the normalisation job
* ``captures_from_suppliers`` -- location-search capture documents for the linkage job
* ``raw_from_lineitem`` -- a large raw table for benchmarking (seven years of history)

nation / region are fixed 25 / 5 row dimensions (by the TPC-H definition), so they are broadcast
unconditionally; customer and supplier grow with the data and are joined by a regular join that AQE
plans from measured sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW_COLUMNS
from ..session import spread

# run date stamped on the synthetic batches
BATCH_DATE = "2024-01-31"


# tables that grow with the data and are dealt out as they are read (lineitem by its key, see ``raw_from_lineitem``)
FACT_TABLES = {"events", "orders"}
LINE_ROWS = 200_000  # rows of lineitem a task sorts as wide staging rows: about 80 MB


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in FACT_TABLES else df


def slug(n_name: Column, r_name: Column) -> Column:
    """'NATION_3' + 'MIDDLE EAST' -> 'nation-3-middle-east'."""
    return F.concat(F.lower(F.regexp_replace(n_name, "_", "-")), F.lit("-"),
                    F.lower(F.regexp_replace(r_name, " ", "-")))


def _geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
            .select("n_nationkey", "n_name", "n_regionkey", "r_name",
                    slug(F.col("n_name"), F.col("r_name")).alias("source_city")))


def scrape_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scrape-target slug (one per nation), mapped in the seed or not."""
    return _geo(spark, sf_dir).select("source_city")


def lookup_from_nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City seed: one row per nation except every sixth (5, 11, 17, 23 stay unmapped)."""
    g = _geo(spark, sf_dir).filter(F.col("n_nationkey") % 6 != 5)
    nk, rk = F.col("n_nationkey"), F.col("n_regionkey")
    return g.select(
        "source_city",
        F.concat(F.lit("Miasto "), nk.cast("string")).alias("city_name"),
        F.lower(F.col("r_name")).alias("voivodeship"),
        (rk == 3).alias("is_mvp"),
        (F.lit(40) + nk).cast("double").alias("bbox_lat_min"),
        (F.lit(40) + nk + F.lit(0.45)).alias("bbox_lat_max"),
        (F.lit(10) + rk).cast("double").alias("bbox_lon_min"),
        (F.lit(10) + rk + F.lit(0.29)).alias("bbox_lon_max"),
    )


def _events_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _read(spark, sf_dir, "events")
    customer = _read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return (events.join(customer, events.user_id == customer.c_custkey)
            .join(F.broadcast(_geo(spark, sf_dir)), F.col("c_nationkey") == F.col("n_nationkey")))


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("long")


def raw_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows (22 columns). id = user_id, date_collected = ts."""
    e = _events_geo(spark, sf_dir).withColumn("k", _k())
    eid, k, et = F.col("event_id"), F.col("k"), F.col("event_type")
    return e.select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("https://listings.example/ad/"), F.col("user_id").cast("string")).alias("url"),
        F.concat(et, F.lit(" flat "), F.col("user_id").cast("string")).alias("title"),
        F.when(eid % 13 == 0, F.lit("n/a")).otherwise(
            F.concat(F.date_format(F.col("ts") - F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd'T'HH:mm:ss"),
                     F.lit("+02:00"))).alias("created_time"),
        F.col("ts").alias("date_collected"),
        F.col("n_name").alias("city"),
        F.when(eid % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("c_mktsegment")).alias("district"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(40) + F.col("n_nationkey") + (eid % 50) / F.lit(100.0)).alias("latitude"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(10) + F.col("n_regionkey") + (eid % 30) / F.lit(100.0)).alias("longitude"),
        F.col("value").alias("price"),
        F.lit("PLN").alias("currency"),
        k.cast("double").alias("area_sqm"),
        F.when(eid % 3 == 0, F.lit(None).cast("double")).otherwise(k * F.lit(10.0)).alias("extra_rent_pln"),
        (F.lit(1) + k % 6).cast("long").alias("num_rooms"),
        (k % 6 == 5).alias("rooms_capped"),
        F.when(k % 13 == 12, F.lit(None).cast("long")).otherwise(k % 13).cast("long").alias("floor"),
        (k % 13 == 11).alias("floor_capped"),
        F.when(et == "error", F.lit(None).cast("boolean")).otherwise(et.isin("view", "purchase")).alias("is_furnished"),
        F.when(et == "view", "blok").when(et == "click", "kamienica").when(et == "purchase", "apartamentowiec")
         .when(et == "signup", "dom wolnostojacy").alias("building_type"),
        F.when(et == "purchase", "primary").when(et == "signup", F.lit(None)).otherwise(F.lit("secondary"))
         .alias("market_type"),
        F.when(k == 0, F.lit(None).cast("double")).when(eid % 41 == 0, F.col("value") / k * F.lit(1.2))
         .otherwise(F.col("value") / k).alias("price_per_sqm_listed"),
        F.col("source_city"),
    )


def raw_sparse_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scrapes, dealt to many more listings: a listing is a user's flat of one size, scraped once or a few times.
    So on any day some listings are new, some are scraped again and some are not."""
    ids = F.col("id") * 1000 + F.col("area_sqm").cast("long")
    return raw_from_events(spark, sf_dir).withColumn("id", ids)


def gate_batches_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed city batches for the quality gate: one batch per nation, ``seq`` = row order.

    Defects are planted on ``event_id % 41 = 0`` and, for every fifth nation, ``event_id % 9 = 0``
    (so those batches are systemic); the defect kind cycles over the rules by ``(event_id div 7) % 9``.
    Rows with ``event_id % 89 = 0`` share one id per batch (duplicate ids).
    """
    e = _events_geo(spark, sf_dir).withColumn("k", _k())
    eid, k, nk = F.col("event_id"), F.col("k"), F.col("n_nationkey")
    bad = (eid % 41 == 0) | ((nk % 5 == 0) & (eid % 9 == 0))
    kind = F.expr("(event_id div 7) % 9")

    def defect(n: int) -> Column:
        return bad & (kind == n)

    price = F.col("value") + F.lit(1)
    area = (k + 10).cast("double")
    dup_district = (nk % 4 == 0) & (eid % 2 == 0)
    return e.select(
        F.col("source_city"),
        F.lit(BATCH_DATE).cast("date").alias("batch_date"),
        eid.alias("seq"),
        F.when(eid % 89 == 0, -(nk + 1000)).otherwise(eid).cast("long").alias("id"),
        F.when(defect(2), F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("https://listings.example/ad/"), eid.cast("string"))).alias("url"),
        F.when(defect(3), F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("city"),
        F.when((eid % 5 == 0) | dup_district, F.lit(None).cast("string"))
         .otherwise(F.col("c_mktsegment")).alias("district"),
        F.when(defect(0), F.lit(-100.0)).otherwise(price).alias("price"),
        F.when(defect(1), F.lit(3.0)).otherwise(area).alias("area_sqm"),
        F.when(defect(8), F.lit(50)).otherwise(F.lit(1) + k % 6).cast("long").alias("num_rooms"),
        F.when(defect(4), F.lit(None).cast("boolean")).otherwise(k % 6 == 5).alias("rooms_capped"),
        (k % 13).cast("long").alias("floor"),
        (k % 13 == 11).alias("floor_capped"),
        F.when(defect(5), F.lit("unknown")).when(F.col("event_type") == "purchase", "primary")
         .when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.lit("secondary")).alias("market_type"),
        F.when(defect(6), F.lit(500.0)).otherwise(price / area).alias("price_per_sqm_listed"),
        F.when(defect(7), F.lit(0.0)).when(eid % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(40) + nk + (eid % 40) / F.lit(100.0)).alias("latitude"),
        F.when(eid % 7 == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(10) + F.col("n_regionkey") + (eid % 25) / F.lit(100.0)).alias("longitude"),
    )


def items_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested listing items as JSON text (one item per event), with a page/position sequence.

    The labels are written the way the listing source shows them ('34,5 m²', '4 i więcej', 'Parter',
    'Powyżej 10', 'Tak', 'Wtórny', '6750 zł/m²'); every 23rd item has a duplicated 'm' param (the
    later one wins); every 31st item is malformed: truncated text, or a location of the wrong shape.
    """
    e = _events_geo(spark, sf_dir).withColumn("k", _k())
    eid, k, et = F.col("event_id"), F.col("k"), F.col("event_type")
    half = F.concat((k / 2).cast("long").cast("string"),
                    F.when(k % 2 == 1, F.lit(",5")).otherwise(F.lit("")))
    rooms_label = F.when(k % 7 == 0, F.lit("Kawalerka")).when(k % 7 == 6, F.lit("4 i więcej")) \
        .when(k % 7 == 5, F.lit("10 pokoi i więcej")).otherwise(F.concat((k % 7).cast("string"), F.lit(" pokoje")))
    floor_label = F.when(k % 12 == 0, F.lit("Parter")).when(k % 12 == 11, F.lit("Powyżej 10")) \
        .when(k % 12 == 10, F.lit(None)).otherwise((k % 12).cast("string"))
    furn = F.when(et == "view", F.lit("Tak")).when(et == "click", F.lit("Nie"))
    mkt = F.when(et == "purchase", F.lit("Pierwotny")).when(et == "view", F.lit("Wtórny")) \
        .when(et == "click", F.lit("wtórny ")).when(et == "signup", F.lit("Inny"))

    def generic(key: str, label: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.struct(
            F.lit("GenericParam").alias("__typename"), F.lit(key).alias("key"), label.alias("label"),
            F.lit(None).cast("double").alias("value"), F.lit(None).cast("string").alias("currency")).alias("value"))

    price_param = F.struct(F.lit("price").alias("key"), F.struct(
        F.lit("PriceParam").alias("__typename"), F.lit("price").alias("key"), F.lit(None).cast("string").alias("label"),
        (F.col("value") * 1000).alias("value"), F.lit("PLN").alias("currency")).alias("value"))
    params = F.array(
        price_param,
        generic("m", F.when(eid % 23 == 0, F.lit("999 m²")).otherwise(F.concat(half, F.lit(" m²")))),
        generic("rent", F.concat(k.cast("string"), F.lit("0 zł"))),
        generic("price_per_m", F.concat((F.col("value") * 10).cast("long").cast("string"), F.lit(" zł/m²"))),
        generic("rooms", rooms_label),
        generic("floor_select", floor_label),
        generic("furniture", furn),
        generic("market", mkt),
        generic("builttype", F.when(et == "error", F.lit(None)).otherwise(F.lit("Blok"))),
        generic("m", F.concat(half, F.lit(" m²"))),
    )
    item = F.struct(
        F.when(eid % 89 == 0, -(F.col("n_nationkey") + 1000)).otherwise(eid).cast("long").alias("id"),
        F.concat(F.lit("https://listings.example/ad/"), eid.cast("string")).alias("url"),
        F.concat(et, F.lit(" flat")).alias("title"),
        F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")).alias("created_time"),
        F.struct(F.struct(F.col("n_name").alias("name")).alias("city"),
                 F.when(eid % 5 == 0, F.lit(None)).otherwise(
                     F.struct(F.col("c_mktsegment").alias("name"))).alias("district")).alias("location"),
        F.when(eid % 7 == 0, F.lit(None)).otherwise(F.struct(
            (F.lit(40) + F.col("n_nationkey") + (eid % 50) / F.lit(100.0)).alias("lat"),
            (F.lit(10) + F.col("n_regionkey") + (eid % 30) / F.lit(100.0)).alias("lon"))).alias("map"),
        params.alias("params"),
    )
    broken = F.concat(F.lit("{\"id\": "), eid.cast("string"), F.when(eid % 62 == 0, F.lit(", \"location\": \"n/a\", \"params\": []}")).otherwise(F.lit(", \"params\": [")))
    text = F.when(eid % 31 == 0, broken).otherwise(F.to_json(item))
    return e.select(
        F.col("source_city"),
        F.lit(BATCH_DATE).cast("date").alias("batch_date"),
        eid.alias("seq"),
        text.alias("item_json"),
    )


def captures_from_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location-search capture documents (doc_id, doc JSON text).

    One entry per supplier: city id ``nationkey*10 + suppkey % 3`` (so (city, region) pairs repeat),
    a city name spelt three ways that all fold to 'miasto <nationkey>', the region of the supplier's
    nation (the next region for every 7th supplier; no region id for every 11th). Every 5th supplier
    is captured alone as a single-object document; the rest are grouped four per document, as a bare
    list or wrapped in {"data": [...]} by turns, and every 13th group is unreadable text.
    """
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    sk = F.col("s_suppkey")
    s = supplier.join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    rk = F.when(sk % 7 == 0, (F.col("n_regionkey") + 1) % 5).otherwise(F.col("n_regionkey"))
    s = s.withColumn("rk", rk).join(F.broadcast(region), F.col("rk") == F.col("r_regionkey"))
    nk = F.col("s_nationkey").cast("string")
    name = F.when(sk % 3 == 0, F.concat(F.lit("Miasto "), nk)) \
        .when(sk % 3 == 1, F.concat(F.lit("MIASTÓ "), nk)) \
        .otherwise(F.concat(F.lit(" miaśto "), nk))
    entry = F.struct(
        F.struct((F.col("s_nationkey") * 10 + sk % 3).cast("long").alias("id"), name.alias("name")).alias("city"),
        F.struct(F.when(sk % 11 == 0, F.lit(None)).otherwise(F.col("rk")).cast("long").alias("id"),
                 F.col("r_name").alias("name")).alias("region"),
    )
    grp = F.expr("s_suppkey div 4")
    doc_id = F.when(sk % 5 == 0, sk * 10 + 1).otherwise(grp * 10).cast("long")
    grouped = (s.select(doc_id.alias("doc_id"), sk, entry.alias("entry"))
               .groupBy("doc_id")
               .agg(F.sort_array(F.collect_list(F.struct("s_suppkey", "entry"))).alias("es")))
    entries = F.transform(F.col("es"), lambda x: x["entry"])
    g = F.col("doc_id") / 10
    text = F.when(F.col("doc_id") % 10 == 1, F.to_json(F.element_at(entries, 1))) \
        .when(g.cast("long") % 13 == 7, F.lit("not json {")) \
        .when(g.cast("long") % 2 == 1, F.to_json(F.struct(entries.alias("data")))) \
        .otherwise(F.to_json(entries))
    return grouped.select(F.col("doc_id"), text.alias("doc"))


def raw_from_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large raw table for benchmarking: id = l_orderkey, one scrape per line item.

    ``date_collected`` = ship date, which ties within an order; the extra columns ``l_linenumber``,
    ``l_partkey``, ``l_suppkey`` are kept as the tiebreak of every latest-row ordering. Lines are dealt out by order while
    they are narrow: every later step per listing finds its rows together.
    """
    li = spread(_read(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_shipdate", "l_returnflag"), "l_orderkey", rows=LINE_ROWS)
    supplier = _read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    geo = _geo(spark, sf_dir)
    j = li.join(supplier, li.l_suppkey == supplier.s_suppkey) \
        .join(F.broadcast(geo), F.col("s_nationkey") == F.col("n_nationkey"))
    price = F.col("l_extendedprice")
    area = F.col("l_quantity") + F.lit(10.0)
    row = {
        "id": F.col("l_orderkey"),
        "url": F.concat(F.lit("https://listings.example/ad/"), F.col("l_orderkey").cast("string")),
        "title": F.lit(None).cast("string"),
        "created_time": F.lit(None).cast("string"),
        "date_collected": F.col("l_shipdate"),
        "city": F.col("n_name"),
        "district": F.when(F.col("l_linenumber") == 1, F.lit(None)).otherwise(F.col("l_returnflag")),
        "latitude": F.lit(None).cast("double"),
        "longitude": F.lit(None).cast("double"),
        "price": price,
        "currency": F.lit("PLN"),
        "area_sqm": area,
        "extra_rent_pln": F.lit(None).cast("double"),
        "num_rooms": F.col("l_linenumber").cast("long"),
        "rooms_capped": F.lit(False),
        "floor": F.lit(None).cast("long"),
        "floor_capped": F.lit(False),
        "is_furnished": F.lit(None).cast("boolean"),
        "building_type": F.lit(None).cast("string"),
        "market_type": F.when(F.col("l_discount") > 0.05, "primary").otherwise("secondary"),
        "price_per_sqm_listed": price / area,
        "source_city": F.col("source_city"),
    }
    out = j.select(*[row[c].alias(c) for c in RAW_COLUMNS],
                   F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"))
    return out

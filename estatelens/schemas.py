"""Schemas of the nested item, the raw listing table and the seeds."""

from pyspark.sql import types as T

PARAM_VALUE = T.StructType([
    T.StructField("__typename", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("currency", T.StringType()),
])

ITEM_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("created_time", T.StringType()),
    T.StructField("location", T.StructType([
        T.StructField("city", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("district", T.StructType([T.StructField("name", T.StringType())])),
    ])),
    T.StructField("map", T.StructType([
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
    ])),
    T.StructField("params", T.ArrayType(T.StructType([
        T.StructField("key", T.StringType()),
        T.StructField("value", PARAM_VALUE),
    ]))),
])

# Raw listing table. date_collected is a UTC wall-clock timestamp (timestamp_ntz) so day
# boundaries never depend on the session time zone.
RAW_FIELDS = [
    ("id", T.LongType()),
    ("url", T.StringType()),
    ("title", T.StringType()),
    ("created_time", T.StringType()),
    ("date_collected", T.TimestampNTZType()),
    ("city", T.StringType()),
    ("district", T.StringType()),
    ("latitude", T.DoubleType()),
    ("longitude", T.DoubleType()),
    ("price", T.DoubleType()),
    ("currency", T.StringType()),
    ("area_sqm", T.DoubleType()),
    ("extra_rent_pln", T.DoubleType()),
    ("num_rooms", T.LongType()),
    ("rooms_capped", T.BooleanType()),
    ("floor", T.LongType()),
    ("floor_capped", T.BooleanType()),
    ("is_furnished", T.BooleanType()),
    ("building_type", T.StringType()),
    ("market_type", T.StringType()),
    ("price_per_sqm_listed", T.DoubleType()),
    ("source_city", T.StringType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t) for n, t in RAW_FIELDS])
RAW_COLUMNS = [n for n, _ in RAW_FIELDS]

# Typed batch = raw row without the load-time source_city stamp.

LOOKUP_SCHEMA = T.StructType([
    T.StructField("source_city", T.StringType()),
    T.StructField("city_name", T.StringType()),
    T.StructField("voivodeship", T.StringType()),
    T.StructField("is_mvp", T.BooleanType()),
    T.StructField("bbox_lat_min", T.DoubleType()),
    T.StructField("bbox_lat_max", T.DoubleType()),
    T.StructField("bbox_lon_min", T.DoubleType()),
    T.StructField("bbox_lon_max", T.DoubleType()),
])

LOCATION_IDS_SCHEMA = T.StructType([
    T.StructField("source_city", T.StringType()),
    T.StructField("city_id", T.LongType()),
    T.StructField("region_id", T.LongType()),
    T.StructField("matched_label", T.StringType()),
])

CAPTURE_ENTRY = T.StructType([
    T.StructField("city", T.StructType([T.StructField("id", T.LongType()),
                                        T.StructField("name", T.StringType())])),
    T.StructField("region", T.StructType([T.StructField("id", T.LongType()),
                                          T.StructField("name", T.StringType())])),
])

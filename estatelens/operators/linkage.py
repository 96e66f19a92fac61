"""Location linkage: match target cities to captured location-search candidates.

Captures are JSON documents in three accepted shapes (a bare list of entries, ``{"data": [...]}``,
or one entry object); anything else is skipped. Entries without both ids are dropped and repeated
(city id, region id) pairs keep their first occurrence (document order, then position).

Matching is a join on the folded city name (diacritics stripped, lower-cased), then per target:
one candidate in the target's own region -> OK; several -> AMBIGUOUS (first taken); none in region
but exactly one anywhere -> FALLBACK; several -> AMBIGUOUS (first taken); no candidate -> MISS.
All steps are joins and grouped aggregates; the per-target ranking runs over that target's
candidates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import fold
from ..schemas import CAPTURE_ENTRY
from ..session import written

OK, AMBIGUOUS, FALLBACK, MISS = "OK", "AMBIGUOUS", "FALLBACK", "MISS"


def read_capture_docs(spark: SparkSession, path: str) -> DataFrame:
    """One document per file (whole text), numbered by file name like a sorted directory listing.

    Only the names are sorted: range-partitioned, numbered within each range, and shifted by the ranges before. Documents
    get their number by a join on the name and never meet in one task.
    """
    df = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("doc"))
    names = written(df.select("file").distinct().repartitionByRange("file").withColumn("_range", F.spark_partition_id()), "capture-names")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    shifts = names.groupBy("_range").agg(F.count(F.lit(1)).alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("file"))
    numbers = names.join(shifts, "_range").select("file", (place + F.col("_before")).cast("long").alias("doc_id"))
    return df.join(numbers, "file").select("doc_id", "doc")


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Capture files -> entries (doc_id, pos, city/region ids and names); unreadable files skipped."""
    return parse_capture_docs(read_capture_docs(spark, path))


def parse_capture_docs(docs: DataFrame) -> DataFrame:
    """docs (doc_id, doc) -> entries (doc_id, pos, city_id, city_name, region_id, region_name)."""
    lst = F.from_json(F.col("doc"), T.ArrayType(CAPTURE_ENTRY))
    wrapped = F.from_json(F.col("doc"), T.StructType([T.StructField("data", T.ArrayType(CAPTURE_ENTRY))]))
    single = F.from_json(F.col("doc"), CAPTURE_ENTRY)
    head = F.regexp_extract(F.col("doc"), r"^\s*(\S)", 1)
    has_data = F.get_json_object(F.col("doc"), "$.data").isNotNull()
    has_city = F.get_json_object(F.col("doc"), "$.city").isNotNull()
    data_is_list = F.regexp_extract(F.get_json_object(F.col("doc"), "$.data"), r"^\s*(\S)", 1) == "["
    entries = (F.when(head == "[", lst)
               .when((head == "{") & has_data & data_is_list, wrapped["data"])
               .when((head == "{") & ~has_data & has_city, F.array(single)))
    x = docs.select("doc_id", F.posexplode(entries).alias("pos", "e"))
    return x.select("doc_id", F.col("pos").cast("long").alias("pos"),
                    F.col("e.city.id").alias("city_id"), F.col("e.city.name").alias("city_name"),
                    F.col("e.region.id").alias("region_id"), F.col("e.region.name").alias("region_name"))


def candidates(entries: DataFrame) -> DataFrame:
    """Drop entries without ids; keep the first occurrence of each (city_id, region_id)."""
    e = entries.filter(F.col("city_id").isNotNull() & F.col("region_id").isNotNull())
    w = Window.partitionBy("city_id", "region_id").orderBy("doc_id", "pos")
    e = e.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
    return e.select("doc_id", "pos", "city_id", "city_name", "region_id", "region_name",
                    fold(F.coalesce(F.col("city_name"), F.lit(""))).alias("name_norm"),
                    fold(F.coalesce(F.col("region_name"), F.lit(""))).alias("region_norm"))


def link(targets: DataFrame, cands: DataFrame) -> DataFrame:
    """targets (source_city, city_name, voivodeship) -> (source_city, status, city_id, region_id,
    matched_label, n_candidates, n_in_region)."""
    t = targets.select("source_city", fold(F.col("city_name")).alias("name_norm"),
                       fold(F.col("voivodeship")).alias("t_region_norm"))
    j = t.join(cands, "name_norm", "left")
    in_region = F.col("region_norm") == F.col("t_region_norm")
    w_all = Window.partitionBy("source_city")
    j = j.withColumn("n_candidates", F.count("city_id").over(w_all)) \
        .withColumn("n_in_region", F.sum(F.when(in_region, 1).otherwise(0)).over(w_all).cast("long"))
    rank = Window.partitionBy("source_city").orderBy(F.when(in_region, 0).otherwise(1), "doc_id", "pos")
    first = j.withColumn("_rn", F.row_number().over(rank)).filter(F.col("_rn") == 1)
    status = (F.when(F.col("n_candidates") == 0, MISS)
              .when(F.col("n_in_region") == 1, OK)
              .when(F.col("n_in_region") > 1, AMBIGUOUS)
              .when(F.col("n_candidates") == 1, FALLBACK)
              .otherwise(AMBIGUOUS))
    miss = F.col("n_candidates") == 0
    return first.select(
        "source_city", status.alias("status"),
        F.when(~miss, F.col("city_id")).alias("city_id"),
        F.when(~miss, F.col("region_id")).alias("region_id"),
        F.when(~miss, F.concat_ws(", ", F.col("city_name"), F.col("region_name"))).alias("matched_label"),
        F.col("n_candidates").cast("long").alias("n_candidates"), "n_in_region")


def location_ids(matches: DataFrame) -> DataFrame:
    """The location-id table: every matched target (MISS rows left out)."""
    return matches.filter(F.col("status") != MISS).select("source_city", "city_id", "region_id", "matched_label")


def link_report(matches: DataFrame) -> DataFrame:
    return matches.groupBy("status").agg(F.count(F.lit(1)).alias("targets"))


def coverage(targets: DataFrame, ids: DataFrame) -> DataFrame:
    """Targets with their search mode: by location ids when mapped, else free-text fallback."""
    m = ids.select("source_city", F.lit(True).alias("_m"))
    return targets.select("source_city").join(m, "source_city", "left").select(
        "source_city", F.coalesce(F.col("_m"), F.lit(False)).alias("mapped"),
        F.when(F.col("_m").isNull(), "free_text").otherwise("location_id").alias("search_mode"))

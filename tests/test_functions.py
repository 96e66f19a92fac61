"""Label decoders and scalar helpers on hand-built frames (cases modelled on the source parser's tests)."""

import pytest
from pyspark.sql import functions as F

from estatelens.functions import (bool_label, floor, fold, initcap_words, leading_number, market, rooms, round2,
                                  surrogate_key, to_utc_wallclock)


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x")).alias("y")).collect()]


def test_leading_number(spark):
    # the first run of digits/blanks/','/'.' is taken: in 'abc 5' that is ' 5', in 'a b 5' it is a lone blank
    nbsp = "1" + chr(0xA0) + "234 zł"
    vals = ["48,5 m²", "58 m²", "650 zł", "6750 zł/m²", "1 234 zł", "1.234,5 m²", nbsp, "abc 5", "a b 5",
            "", None, "5,", ".5 m²"]
    got = one_col(spark, vals, leading_number)
    assert got == [48.5, 58.0, 650.0, 6750.0, 1234.0, None, None, 5.0, None, None, None, 5.0, 0.5]


def test_rooms(spark):
    vals = ["2 pokoje", "Kawalerka", "4 i więcej", "10 pokoi i więcej", "1 pokój", "brak", None, "", "5 i wiecej"]
    got = [(r["num_rooms"], r["rooms_capped"]) for r in one_col(spark, vals, rooms)]
    assert got == [(2, False), (1, False), (4, True), (10, True), (1, False), (None, False), (None, False),
                   (None, False), (5, True)]


def test_floor(spark):
    vals = ["Parter", "9", "Powyżej 10", None, " parter ", "powyzej", "3 piętro"]
    got = [(r["floor"], r["floor_capped"]) for r in one_col(spark, vals, floor)]
    assert got == [(0, False), (9, False), (10, True), (None, False), (0, False), (None, True), (3, False)]


def test_bool_and_market(spark):
    assert one_col(spark, ["Tak", "Nie", None, "", " TAK "], bool_label) == [True, False, None, False, True]
    assert one_col(spark, ["Pierwotny", "Wtórny", "Inny", None, "", " wtórny "], market) == \
        ["primary", "secondary", None, None, None, "secondary"]


def test_fold_and_initcap(spark):
    assert one_col(spark, ["Łódź ", "Wałbrzych", "Bielsko-Biała", "ZIELONA GÓRA"], fold) == \
        ["lodz", "walbrzych", "bielsko-biala", "zielona gora"]
    assert one_col(spark, ["bielsko-biala", "zielona-gora", "ruda slaska", "a_b.c", None], initcap_words) == \
        ["Bielsko-Biala", "Zielona-Gora", "Ruda Slaska", "A_B.C", None]


def test_round2_ties_and_keys(spark):
    assert one_col(spark, [2.675, 1.005, 0.125, None], round2, "double") == [2.68, 1.01, 0.13, None]
    df = spark.createDataFrame([(1, None)], "a long, b string")
    k = df.select(surrogate_key(F.col("a")).alias("k1"), surrogate_key(F.col("a"), F.col("b")).alias("k2")).first()
    import hashlib
    assert k["k1"] == hashlib.md5(b"1").hexdigest()
    assert k["k2"] == hashlib.md5(b"1-_dbt_utils_surrogate_key_null_").hexdigest()


@pytest.mark.parametrize("tz", ["UTC", "Europe/Warsaw", "America/New_York"])
def test_utc_wallclock_independent_of_session_zone(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        got = one_col(spark, ["2024-01-01T10:00:00+02:00", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00", "junk"],
                      to_utc_wallclock)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [str(g) if g else None for g in got] == ["2024-01-01 08:00:00", "2024-01-01 10:00:00",
                                                    "2024-01-01 10:00:00", None]

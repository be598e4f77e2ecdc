from __future__ import annotations

from pyspark.sql import functions as F

from strata.functions import (
    change_hash,
    clean_city,
    clean_state,
    clean_zip,
    date_key,
    surrogate_key,
    to_decimal,
    to_double,
    to_int,
    to_ts,
)
from strata.functions.text import clean_header


def test_safe_int_cast_never_fails_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("225.0",), (" 7 ",), ("abc",), ("99999999999",), (None,), ("-5",), ("1.9",)], "s string")
    got = [r[0] for r in df.select(to_int("s")).collect()]
    assert got == [225, 7, None, None, None, -5, 1]


def test_decimal_rounds_half_up_and_junk_is_null(spark):
    df = spark.createDataFrame([("1.005",), ("abc",), ("10.00",), ("-1",)], "s string")
    got = [r[0] for r in df.select(to_decimal("s").cast("string")).collect()]
    assert got == ["1.01", None, "10.00", "-1.00"]


def test_double_and_timestamp(spark):
    df = spark.createDataFrame([("45", "2017-01-05 10:00:00"), ("x", "bad"), (None, "2017-01")], "a string, t string")
    rows = df.select(to_double("a").alias("a"), to_ts("t").cast("string").alias("t")).collect()
    assert [r.a for r in rows] == [45.0, None, None]
    assert [r.t for r in rows] == ["2017-01-05 10:00:00", None, "2017-01-01 00:00:00"]


def test_text_cleanup(spark):
    df = spark.createDataFrame([("1310", " sao PAULO-x d'oeste ", "sp"), ("123456", None, " rj ")], "z string, c string, s string")
    rows = df.select(clean_zip("z").alias("z"), clean_city("c").alias("c"), clean_state("s").alias("s")).collect()
    assert rows[0].z == "01310" and rows[1].z == "12345"
    assert rows[0].c == "Sao Paulo-x D'oeste" and rows[1].c is None
    assert rows[0].s == "SP" and rows[1].s == "RJ"


def test_header_cleaning():
    assert clean_header("﻿product_category_name ") == "product_category_name"


def test_date_key_keeps_null(spark):
    df = spark.createDataFrame([("2017-01-05 10:00:00",), (None,)], "t string").select(to_ts("t").alias("t"))
    assert [r[0] for r in df.select(date_key("t")).collect()] == [20170105, None]


def test_surrogate_key_maps_null_to_unknown(spark):
    df = spark.createDataFrame([("a",), (None,)], "k string")
    rows = df.select(surrogate_key("k").alias("k"), F.xxhash64("k").alias("raw")).collect()
    assert rows[0].k == rows[0].raw
    assert rows[1].k == -1 and rows[1].raw == 42  # plain xxhash64(NULL) is its seed


def test_change_hash_matches_sha256_of_text(spark):
    import hashlib

    df = spark.createDataFrame([("a", 1), (None, 2)], "x string, y int")
    got = [r[0] for r in df.select(change_hash(["x", "y"])).collect()]
    assert got[0] == hashlib.sha256(b"a||1").hexdigest()
    assert got[1] == hashlib.sha256(b"<null>||2").hexdigest()

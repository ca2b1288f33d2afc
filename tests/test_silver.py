"""Silver: row-by-row time parsing, NaN/missing values, schema conformance."""

import datetime as dt

from pyspark.sql import functions as F

from meterlake.functions.timeparse import parse_reading_time
from meterlake.operators.silver import conform, to_silver
from meterlake.schema import BRONZE, SILVER


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(parse_reading_time(F.col("t"))).collect()]


def test_dayfirst_and_iso_never_swapped(spark):
    got = parse(spark, ["02.01.2025 00:15", "2025-01-02", "2025-01-02 03:04:05",
                        "02/01/2025 23:59:59", "2025-01-02T03:04", "1.2.2025 1:02:03.5"])
    assert got == [dt.datetime(2025, 1, 2, 0, 15), dt.datetime(2025, 1, 2),
                   dt.datetime(2025, 1, 2, 3, 4, 5), dt.datetime(2025, 1, 2, 23, 59, 59),
                   dt.datetime(2025, 1, 2, 3, 4), dt.datetime(2025, 2, 1, 1, 2, 3, 500000)]


def test_bad_times_are_null(spark):
    # month 13, 31 Feb, words, bare numbers (S13) and empty text
    assert parse(spark, ["01.13.2025", "31.02.2025", "Summe", "45678", "45678.5", "", None]) \
        == [None] * 7


def test_wall_clock_independent_of_session_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        # 02:30 on the spring-forward day does not exist in Berlin; kept as is
        assert parse(spark, ["30.03.2025 02:30"]) == [dt.datetime(2025, 3, 30, 2, 30)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _bronze(spark, rows):
    full = []
    for ts, v in rows:
        full.append(("H1", "k", "Hall H1", "h1_k", "M", "", 15, "f.xlsx", 0, 5, ts, "s", v, {}))
    return spark.createDataFrame(full, BRONZE)


def test_to_silver_drops_bad_times_keeps_null_values(spark):
    b = _bronze(spark, [("01.01.2025 00:00", 1.0), ("Summe", 2.0), ("01.01.2025 00:15", None),
                        ("01.01.2025 00:30", float("nan"))])
    s = to_silver(b)
    assert [(f.name, f.dataType) for f in s.schema] == [(f.name, f.dataType) for f in SILVER]
    got = [(r.timestamp.minute, r.value) for r in s.orderBy("timestamp").collect()]
    assert got == [(0, 1.0), (15, None), (30, None)]     # NaN -> NULL, no fill


def test_fill_missing_option(spark):
    b = _bronze(spark, [("01.01.2025 00:15", None)])
    assert to_silver(b, fill_missing=0).collect()[0].value == 0.0


def test_conform_adds_and_drops(spark):
    df = spark.createDataFrame([("H1", "x", 1.5)], "HALL_ID string, extra string, value double")
    out = conform(df)
    assert out.columns == [f.name for f in SILVER.fields]
    r = out.collect()[0]
    assert (r.hall_id, r.value, r.meter_id) == ("H1", 1.5, None)

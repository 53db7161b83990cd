from datetime import date, datetime

from pyspark.sql import functions as F

from lograft.functions import times


def test_timestamp_forms(spark):
    rows = [
        ("2024-03-05T07:08:09.010Z", datetime(2024, 3, 5, 7, 8, 9, 10000)),
        ("1709622489016000000", datetime(2024, 3, 5, 7, 8, 9, 16000)),
        ("2023-06-22T11:28-05:00", datetime(2023, 6, 22, 16, 28)),
        ("2023-12-19T22:09:17.440Z", datetime(2023, 12, 19, 22, 9, 17, 440000)),
        ("2023-12-19T22:09:17.440123456+00:00", datetime(2023, 12, 19, 22, 9, 17, 440123)),
        ("Unknown", None),
        (None, None),
        ("9" * 38, None),
        ("9" * 19, None),
        ("9000000000000000000", datetime(2255, 3, 14, 16, 0)),
        ("12:30:00", None),
        ("2024", datetime(1970, 1, 1, 0, 0, 0, 2)),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "t string")
    got = [r.ts for r in df.select(times.parse_timestamp("t").alias("ts")).collect()]
    assert got == [r[1] for r in rows]


def test_date_with_offset(spark):
    df = spark.createDataFrame([("2023-06-23+02:00",), ("Unknown",)], "t string")
    assert [r.d for r in df.select(times.parse_date("t").alias("d")).collect()] == [date(2023, 6, 23), None]


def test_writer_forms_round_trip(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 7, 179575),), (datetime(2024, 1, 1, 0, 0, 7),)], "ts timestamp")
    out = df.select(
        times.parse_timestamp(times.python_isoformat("ts")).alias("py"),
        times.parse_timestamp(times.rfc3339_auto("ts")).alias("rs"),
        times.parse_timestamp(times.epoch_nanos("ts").cast("string")).alias("ns"),
        times.parse_timestamp(times.iso_millis_z("ts")).alias("ms"),
        times.python_isoformat("ts").alias("pytext"),
    ).collect()
    assert out[0].py == out[0].rs == out[0].ns == datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert out[0].ms == datetime(2024, 1, 1, 0, 0, 7, 179000)
    assert out[1].pytext == "2024-01-01T00:00:07+00:00"


def test_syslog_and_clf(spark):
    df = spark.createDataFrame([("Jan  5 12:00:01", "05/Jan/2024:12:00:01 +0000")], "s string, c string")
    r = df.select(times.parse_syslog_time("s", 2024).alias("s"), times.parse_clf_time(F.col("c")).alias("c")).first()
    assert r.s == r.c == datetime(2024, 1, 5, 12, 0, 1)


def test_units_are_named(spark):
    df = spark.createDataFrame([("1700000000",), ("9999999999999999999",)], "t string")
    got = df.select(*[times.parse_timestamp("t", u).alias(u) for u in ("s", "ms", "us", "ns")]).collect()
    assert got[0].s == datetime(2023, 11, 14, 22, 13, 20) and got[0].ms == datetime(1970, 1, 20, 16, 13, 20)
    assert got[1].s is None and got[1].ms is None and got[1].us is None


def test_nanos_keep_what_micros_cut(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.123456789Z",), ("2024-01-01T00:00:00Z",), ("2024-01-01T00:00:00.5Z",), ("x",)], "t string")
    base = 1704067200 * 10**9
    assert [r.n for r in df.select(times.text_nanos("t").alias("n")).collect()] == [base + 123456789, base, base + 500000000, None]

import datetime as dt

from pyspark.sql import functions as F

from constella.functions import date_attributes, default_array, first_element, parse_timestamp


def test_first_element_null_and_empty_arrays(spark):
    df = spark.createDataFrame([([{"a": 1}],), ([],), (None,)], "xs array<struct<a:int>>")
    got = [r[0] for r in df.select(first_element("xs", "a")).collect()]
    assert got == [1, None, None]


def test_default_array(spark):
    df = spark.createDataFrame([(["x"],), ([],), (None,)], "g array<string>")
    assert [r[0] for r in df.select(default_array("g")).collect()] == [["x"], [], ["other"]]
    assert [r[0] for r in df.select(default_array("g", empty_as_default=True)).collect()] == \
        [["x"], ["other"], ["other"]]


def test_parse_timestamp_malformed_is_null(spark):
    df = spark.createDataFrame([("2024-01-05 10:00:00",), ("2024-01-06",), ("oops",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_timestamp("s")).collect()]
    assert got == [dt.datetime(2024, 1, 5, 10), dt.datetime(2024, 1, 6), None, None]


def test_date_attributes_weekend_and_iso_week(spark):
    days = ["2021-01-01", "2021-01-02", "2021-01-03", "2021-01-04"]  # Fri, Sat, Sun, Mon
    df = spark.createDataFrame([(d,) for d in days], "s string").select(parse_timestamp("s").alias("t"))
    attrs = date_attributes("t")
    rows = df.select(*[attrs[c].alias(c) for c in attrs]).orderBy("date").collect()
    assert [r.is_weekend for r in rows] == [False, True, True, False]
    assert [r.week_of_year for r in rows] == [53, 53, 53, 1]
    assert rows[1].day_of_week == "Saturday" and rows[2].day_of_week == "Sunday"
    assert rows[0].date_key == 20210101 and rows[0].date_full == "January 1, 2021"
    assert rows[0].date_iso == "2021-01-01" and rows[0].month_name == "January"
    assert (rows[0].quarter, rows[0].year, rows[0].day_of_year, rows[0].day_of_month) == (1, 2021, 1, 1)


def test_date_attributes_null_weekend_is_false(spark):
    df = spark.range(1).select(F.lit(None).cast("timestamp_ntz").alias("t"))
    assert df.select(date_attributes("t")["is_weekend"]).first()[0] is False

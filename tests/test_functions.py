from __future__ import annotations

import datetime

from conftest import day
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar, measures
from viewlog.plans import dims


def one(spark, *expressions):
    return tuple(spark.range(1).select(*expressions).first())


def test_parse_day_takes_two_shapes_and_never_fails(spark):
    texts = ["20220401", "2022-04-01", "zz", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [row[0] for row in frame.select(calendar.parse_day("t")).collect()] == [
        day("2022-04-01"), day("2022-04-01"), None, None]


def test_calendar_parts_of_a_weekend(spark):
    frame = spark.createDataFrame([(day(d),) for d in ("2024-01-06", "2024-01-07", "2024-01-08")], "d date")
    got = [tuple(r) for r in frame.select(
        calendar.date_key("d"), F.dayofweek("d"), calendar.is_weekend("d"),
        calendar.month_name("d"), calendar.day_name("d")).collect()]
    assert got == [(20240106, 7, 1, "January", "Saturday"), (20240107, 1, 1, "January", "Sunday"),
                   (20240108, 2, 0, "January", "Monday")]


def test_calendar_is_complete(spark):
    days = dims.dim_date(spark)
    assert days.count() == 4018
    bounds = days.agg(F.min("DateKey"), F.max("DateKey"), F.countDistinct("DateValue")).first()
    assert tuple(bounds) == (20200101, 20301231, 4018)
    leap = days.where("DateKey = 20240229").first()
    assert (leap.Quarter, leap.Month, leap.Day, leap.DateValue) == (1, 2, 29, datetime.date(2024, 2, 29))


def test_category_is_case_sensitive_and_total(spark):
    frame = spark.createDataFrame([("KPLUS",), ("KPlus",), ("kplus",), (None,), ("DANET",)], "AppName string")
    got = [tuple(r) for r in frame.select(measures.category_of(), measures.category_of(labels="en")).collect()]
    assert got == [("Truyền Hình", "TV"), ("Truyền Hình", "TV"), ("Error", "Unknown"), ("Error", "Unknown"),
                   ("Phim Truyện", "Movie")]


def test_small_dimensions_match_the_vocabulary(spark):
    apps = {row.AppName: row.AppCategory for row in dims.dim_app(spark).collect()}
    assert len(apps) == 14 and apps["SPORT"] == "Thể Thao" and apps["KPlus"] == apps["KPLUS"]
    assert dims.dim_app(spark, "error").where("AppKey = 0").first().AppName == schema.OTHER_APP
    types = [tuple(r)[:2] for r in dims.dim_content_type(spark).orderBy("ContentTypeKey").collect()]
    assert types[0] == (1, "Truyền Hình") and types[5] == (6, "Error") and len(types) == 6


def test_best_label_ties_zero_and_null(spark):
    names = ["TV", "Movie", "Kids"]
    frame = spark.createDataFrame(
        [(1, 0, 0, 0), (2, 5, 5, 1), (3, None, 2, 2), (4, None, None, None), (5, -3, -1, -2)],
        "id int, TV long, Movie long, Kids long")
    columns = [F.col(n) for n in names]
    got = [tuple(r) for r in frame.orderBy("id").select(
        measures.best_label(columns, names), measures.best_duration(columns)).collect()]
    assert got == [(None, 0), ("TV", 5), ("Movie", 2), (None, 0), (None, 0)]


def test_levels_at_their_limits(spark):
    frame = spark.createDataFrame([(n,) for n in (1, 2, 3, 9, 10, 19, 20, None)], "days int")
    got = [tuple(r) for r in frame.select(
        measures.level_of("days", schema.SPAN_LIMITS, schema.SPAN_LEVELS),
        measures.level_of("days", schema.SINCE_FIRST_LIMITS, schema.SINCE_FIRST_LEVELS)).collect()]
    assert got == [("Low", "Thấp"), ("Low", "Thấp"), ("Low", "Trung bình"), ("Low", "Trung bình"),
                   ("Medium", "Cao"), ("Medium", "Cao"), ("High", "Cao"), (None, None)]


def test_whole_average_drops_the_fraction_and_skips_null(spark):
    frame = spark.createDataFrame([(1,), (2,), (4,), (None,)], "x long")
    assert frame.agg(measures.whole_average("x")).first()[0] == 2


def test_hours_and_bytes(spark):
    assert one(spark, measures.hours(F.lit(5400))) == (1.5,)
    assert one(spark, measures.byte_length(F.lit("Giải Trí"), F.lit(None))) == (11,)


def test_day_from_name(spark):
    names = ["20220401.json", "log_20220401_v2.json", "notes.json"]
    frame = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in frame.select(calendar.day_from_name("n")).collect()] == ["20220401", "20220401", ""]

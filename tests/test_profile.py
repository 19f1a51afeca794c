from __future__ import annotations

import pytest
from conftest import day, values
from pyspark.sql import Window
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.functions import calendar
from viewlog.operators import aggregates, profile, rows
from viewlog.sources import adapter


@pytest.fixture
def logs(staged):
    return staged(
        ("C1", "M1", "VOD", 100, "2024-01-01"),
        ("C1", "M2", "CHANNEL", 100, "2024-01-10"),
        ("C2", "M3", "OTHER", 70, "2024-01-01"),
        ("C2", None, None, 5, "2024-01-09"),
        ("C3", "M4", "KPLUS", None, "2024-01-01"),
        ("C4", "M5", "KPlus", 10, "2024-01-01"),
        ("C4", "M5", "KPLUS", 20, "2024-01-20"),
        (None, "M6", "VOD", 9, "2024-01-01"),
    )


def test_pivot_has_every_category_even_without_rows(logs):
    wide = profile.duration_pivot(rows.with_category(logs, "en"), "en")
    assert wide.columns == ["Contract", "TV", "Movie", "Entertainment", "Kids", "Sports", "Unknown"]
    got = {row.Contract: row.asDict() for row in wide.collect()}
    assert got["C1"]["TV"] == 100 and got["C1"]["Movie"] == 100 and got["C1"]["Sports"] == 0
    assert got["C2"]["Unknown"] == 75 and got["C3"]["TV"] == 0
    assert None in got


def test_profile_edges(logs):
    got = {row.Contract: row for row in profile.contract_profile(logs, "en").collect()}
    assert set(got) == {"C1", "C2", "C3", "C4"}
    assert (got["C1"].MostWatchContentType, got["C1"].MostWatchDuration) == ("TV", 100)
    assert (got["C2"].MostWatchContentType, got["C2"].MostWatchDuration, got["C2"].Unknown) == (None, 0, 75)
    assert (got["C3"].MostWatchContentType, got["C3"].TV) == (None, 0)
    assert (got["C4"].TotalDevices, got["C4"].TV) == (2, 30)
    assert [got[c].ActivationLevel for c in ("C1", "C2", "C3", "C4")] == ["Medium", "Low", "Low", "High"]


def test_one_pass_profile_equals_the_joined_steps(logs):
    stats = profile.with_most_watched(profile.duration_pivot(rows.with_category(logs)))
    joined = profile.join_activation(
        profile.join_devices(stats, profile.device_rows(logs)), profile.activation_span(logs))
    single = profile.contract_profile(logs)
    assert values(joined, *single.columns) == values(single)


def test_pivot_equals_conditional_sums_on_listed_apps(spark):
    logs = adapter.staging_from_events(spark, "/root/testdata/sf0.001").where(F.col("AppName").isin(*schema.KNOWN_APPS))
    typed = rows.with_category(logs)
    pivot = profile.duration_pivot(typed)
    sums = aggregates.contract_days(typed, "Contract", kind="Type", device="Mac", prefix="D", total="All")
    renamed = sums.select("Contract", *[F.col(f"D_{c.suffix}").alias(c.label) for c in schema.ALL_CATEGORIES])
    assert values(pivot) == values(renamed)


def test_span_equals_its_window_form(spark):
    logs = adapter.staging_from_events(spark, "/root/testdata/sf0.001")
    whole = Window.partitionBy("Contract")
    windowed = logs.select("Contract", calendar.days_inclusive(
        F.min("EventDate").over(whole), F.max("EventDate").over(whole)).alias("days")).distinct()
    assert values(profile.activation_span(logs), "Contract", "ActivationDays") == values(windowed)


def test_span_without_any_date_is_null(spark, staged):
    logs = staged(("C1", "M", "VOD", 1, None))
    assert values(profile.activation_span(logs)) == [("C1", None, None)]


def test_partial_sums_merge_to_the_one_pass_result(logs):
    typed = rows.with_category(logs)
    cut = F.col("EventDate") < F.lit(day("2024-01-05"))
    by_part = [profile.duration_by_category(typed.where(c)) for c in (cut, ~cut)]
    merged = aggregates.merge_partials(*by_part, by=["Contract", "Type"], measure="TotalDuration")
    assert values(merged) == values(profile.duration_by_category(typed))


def test_rows_and_distinct_devices_differ(logs):
    assert dict(values(profile.device_rows(logs)))["C4"] == 2
    assert dict(values(profile.devices_distinct(logs, "Contract")))["C4"] == 1


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([(2,)], "n int")
    assert values(rows.union_by_name(a, b)) == [(1, "x"), (2, None)]


def test_filters(logs):
    assert rows.on_date(logs, "2024-01-01").count() == 5
    assert rows.on_date(logs, None).count() == 8
    assert rows.on_dates(logs, [day("2024-01-09"), day("2024-01-10")]).count() == 2
    assert rows.on_dates(logs, []).count() == 0
    assert rows.between(logs, "2024-01-09", "2024-01-10", "EventDate").count() == 2
    assert rows.complete(logs, "Contract", "Mac", "AppName").count() == 6
    window = rows.trailing(logs, "2024-01-17", 7, "EventDate")
    assert window.count() == 2 and rows.trailing(logs, "2024-01-17", 7, "EventDate", False).count() == 1
    assert rows.of_contract(logs, "C1", "Contract").count() == 2
    assert rows.of_contract(logs, None, "Contract").count() == 8


def test_no_date_adds_no_predicate(logs):
    assert rows.on_date(logs, None) is logs

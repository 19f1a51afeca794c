from __future__ import annotations

import pytest
from conftest import SF_DIR, day, values
from pyspark.sql import functions as F

from viewlog import schema
from viewlog.plans import mart, pipeline, report
from viewlog.plans import warehouse as wh
from viewlog.registry.frames import Frames

AS_OF = "2024-01-30"


@pytest.fixture(scope="module")
def frames(spark):
    return Frames(spark, SF_DIR)


def load(spark, staged, tmp_path, *logs):
    stores = pipeline.stores(spark, str(tmp_path))
    wh.load_warehouse(spark, staged(*logs), stores[0])
    mart.load_mart(spark, *stores)
    return stores


def analytics_of(logs):
    return mart.contract_analytics(mart.with_first_day(mart.days_from_logs(logs), "ContractID"))


def trend_of(logs):
    return mart.content_type_trend(mart.trend_from_logs(logs), "Contract")


VISITS = [("C1", "M1", "VOD", 10, d) for d in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-09", "2024-01-10")]


def activation(marts):
    return values(marts.read(mart.ANALYTICS), "DateValue", "ActivationDays", "ActivationLevel")


def test_since_first_days_and_levels(staged):
    analytics = analytics_of(staged(*VISITS))
    assert [row[1:] for row in values(analytics, "DateValue", "ActivationDays", "ActivationLevel")] == [
        (1, "Thấp"), (2, "Thấp"), (3, "Trung bình"), (9, "Trung bình"), (10, "Cao")]


def test_first_date_scopes_of_a_date_load(spark, staged, tmp_path):
    warehouse, marts = load(spark, staged, tmp_path, *VISITS)
    mart.load_mart(spark, warehouse, marts, "2024-01-10")
    assert activation(marts)[-1] == (day("2024-01-10"), 10, "Cao")
    mart.load_mart(spark, warehouse, marts, "2024-01-10", first_date_scope="filtered")
    assert activation(marts)[-1] == (day("2024-01-10"), 1, "Thấp")
    assert len(activation(marts)) == 5
    with pytest.raises(ValueError):
        mart.load_mart(spark, warehouse, marts, first_date_scope="none")


def test_late_first_date_reaches_later_dates(spark, staged, tmp_path):
    warehouse, marts = load(spark, staged, tmp_path, *VISITS[1:])
    wh.load_warehouse(spark, staged(*VISITS), warehouse, "2024-01-01")
    touched = mart.moved_dates(warehouse)
    assert sorted(touched) == [day(v[4]) for v in VISITS]
    mart.load_mart(spark, warehouse, marts, process_dates=touched)
    assert [row[1] for row in activation(marts)] == [1, 2, 3, 9, 10]
    # Loading an unchanged day again moves nothing.
    wh.load_warehouse(spark, staged(*VISITS), warehouse, "2024-01-01")
    assert mart.moved_dates(warehouse) == []


def test_a_first_date_that_is_taken_back(spark, staged, tmp_path):
    warehouse, marts = load(spark, staged, tmp_path, *VISITS, ("C2", "M1", "VOD", 5, "2024-01-01"))
    wh.load_warehouse(spark, staged(("C2", "M1", "VOD", 5, "2024-01-01")), warehouse, "2024-01-01")
    touched = mart.moved_dates(warehouse)
    assert sorted(touched) == [day(v[4]) for v in VISITS[1:]]
    mart.load_mart(spark, warehouse, marts, process_dates=[day("2024-01-01"), *touched])
    rows = values(marts.read(mart.ANALYTICS), "ContractID", "DateValue", "ActivationDays")
    assert [row[2] for row in rows if row[0] == "C1"] == [1, 2, 8, 9]
    assert [row[2] for row in rows if row[0] == "C2"] == [1]
    wh.load_warehouse(spark, staged(("C3", "M1", "VOD", 5, "2024-01-01")), warehouse, "2024-01-01")
    assert "C2" not in {row[0] for row in values(
        wh.first_dates(warehouse).join(warehouse.read(wh.CONTRACTS), "ContractKey"), "ContractID", "FirstDateKey")}


def test_a_one_date_load_reads_no_other_summary(spark, staged, tmp_path):
    warehouse, _ = load(spark, staged, tmp_path, *VISITS)
    wh.load_warehouse(spark, staged(*VISITS), warehouse, "2024-01-10")
    summary = mart._on_keys(warehouse.read(wh.SUMMARY), [day("2024-01-10")])
    assert {path.split("DateKey=")[1][:8] for path in summary.inputFiles()} >= {"20240110"}
    assert "20240101" not in summary.select(F.col("_metadata.file_path")).distinct().collect()[0][0]


def test_marts_from_logs_equal_marts_from_the_star(frames):
    assert values(frames.analytics) == values(frames.keyed_analytics)
    assert values(frames.daily) == values(frames.keyed_daily) == values(frames.daily_from_logs)
    assert values(frames.trend) == values(frames.keyed_trend) == values(frames.trend_from_logs)


def test_the_leaderboard_prunes_the_stored_mart(frames):
    plan = report.contract_leaderboard(frames.analytics, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert "DateValue" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_daily_contract_count_is_distinct(frames):
    distinct = mart.known_logs(frames.staging).groupBy("EventDate").agg(F.countDistinct("Contract"))
    assert values(frames.daily, "DateValue", "TotalContracts") == values(distinct)


def test_favourite_by_ranking_equals_the_expression(spark):
    columns = [f"TotalDuration_{c.suffix}" for c in schema.CATEGORIES]
    lines = [(1, 0, 0, 0, 0, 0), (2, 5, 5, 1, 0, 0), (3, 0, 0, 2, 2, 9), (4, None, 3, None, 3, None), (5, -1, -1, -1, -1, -1)]
    wide = spark.createDataFrame(lines, "id int, " + ", ".join(f"{c} long" for c in columns))
    ranked = mart.favourite_by_ranking(wide).select("id", "ContentType", "Duration")
    assert values(ranked) == values(
        mart.with_favourite(wide, "TotalDuration").select("id", "MostWatchContentType", "MostWatchDuration"))
    assert values(ranked)[1] == (2, "Truyền Hình", 5)


def test_shared_device_counts_once_per_contract(staged):
    logs = staged(("C1", "M1", "VOD", 1, "2024-01-01"), ("C2", "M1", "VOD", 1, "2024-01-01"))
    daily = mart.daily_summary(mart.days_from_logs(logs))
    assert values(daily, "TotalContracts", "TotalDevices") == [(2, 2)]


def test_clear_marts_counts_before_and_after(spark, staged, tmp_path):
    _, marts = load(spark, staged, tmp_path, *VISITS)
    counts = mart.clear_marts(marts)
    assert counts["before"] == {mart.ANALYTICS: 5, mart.DAILY: 5, mart.TREND: 5}
    assert set(counts["after"].values()) == {0}
    assert marts.read(mart.DAILY).columns == schema.DM_DAILY_SUMMARY.names


def test_media_report_keeps_null_groups_and_other_dates(spark, staged, tmp_path):
    store = mart.media_store(spark, str(tmp_path / "media"))
    logs = staged(("C", "M", "VOD", 1, "2024-01-01"), ("C", "M", None, 2, "2024-01-01"), ("C", "M", "VOD", None, None),
                  ("C", "M", "VOD", 4, "2024-01-02"))
    mart.load_media_report(spark, logs, store)
    wanted = [(None, "VOD", None, 1), (day("2024-01-01"), None, 2, 1), (day("2024-01-01"), "VOD", 1, 1),
              (day("2024-01-02"), "VOD", 4, 1)]
    assert values(store.read(mart.MEDIA)) == wanted
    mart.load_media_report(spark, logs, store, "2024-01-02")
    assert values(store.read(mart.MEDIA)) == wanted


def test_kpis_are_zero_without_rows(frames):
    assert values(report.kpis(frames.daily.where("false"), AS_OF)) == [(0, 0, 0, 0.0, 0)]
    assert values(report.kpis(frames.daily, "2030-01-01")) == [(0, 0, 0, 0.0, 0)]


def test_trailing_windows_with_and_without_the_boundary_day(frames):
    assert report.kpis(frames.daily, AS_OF).first().DaysCount == 8
    assert report.kpis(frames.daily, AS_OF, include_boundary=False).first().DaysCount == 7
    assert report.realtime_daily(frames.daily, AS_OF).count() == 1


def test_ordered_reports_come_out_ordered(frames):
    days = [r.DateValue for r in report.daily_table(frames.daily, "2024-01-05", "2024-01-20").collect()]
    assert days == sorted(days, reverse=True) and len(days) == 16
    lines = [(r.DateValue, r.ContentType) for r in report.trend(frames.trend, AS_OF).collect()]
    assert lines == sorted(lines)
    hours = [r.TotalDuration_Hours for r in report.contract_leaderboard(frames.analytics, AS_OF, n=15).collect()]
    assert hours == sorted(hours, reverse=True) and len(hours) == 15
    ids = [r.ContractID for r in report.contract_list(frames.analytics).collect()]
    assert ids == sorted(set(ids))


def test_leaderboard_breaks_ties_by_contract(staged):
    analytics = analytics_of(staged(*[(f"C{n}", f"M{n}", "VOD", 60, "2024-01-30") for n in range(8)]))
    board = report.contract_leaderboard(analytics, AS_OF, n=5)
    assert [r.ContractID for r in board.collect()] == ["C0", "C1", "C2", "C3", "C4"]
    assert [r.ContractID for r in report.head_of(board, 2).collect()] == ["C0", "C1"]
    assert report.contract_leaderboard(analytics, AS_OF, n=1).count() == 1


def test_leaderboard_labels_are_binary_maxima(staged):
    analytics = analytics_of(staged(("C", "M", "CHILD", 60, "2024-01-29"), ("C", "M", "SPORT", 60, "2024-01-30")))
    assert report.contract_leaderboard(analytics, AS_OF).first().MostWatchContentType == "Thể Thao"


def test_statistics_average_in_whole_seconds(staged):
    by_type = trend_of(staged(("C", "M", "VOD", 1, "2024-01-29"), ("C", "M", "VOD", 2, "2024-01-30")))
    row = report.type_statistics(by_type, AS_OF).first()
    assert row.AvgDuration_Hours == 1 / 3600.0 and row.UniqueContracts == 2


def test_series_of_one_contract_and_of_all(frames):
    one = report.contract_series(frames.analytics, AS_OF, "C00007")
    assert values(one.select("ContractID").distinct()) == [("C00007",)]
    everyone = report.contract_series(frames.analytics, AS_OF, None)
    assert everyone.where("ContractID = 'C00007'").count() == one.count()


def test_report_filter_reaches_the_log_scan(frames):
    """The trailing window is applied to the log rows, below the first aggregation."""
    plan = report.kpis(frames.daily_from_logs, AS_OF)._jdf.queryExecution().optimizedPlan().toString()
    lowest = plan[plan.rindex("Aggregate"):]
    assert "cast(ts" in lowest and ">= 2024-01-23" in lowest

from __future__ import annotations

from datetime import timedelta

import pytest
from conftest import day, values
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewlog.plans import mart, pipeline, report, rollups
from viewlog.plans import warehouse as wh

DAYS = st.dates(day("2023-11-20"), day("2024-05-10"))


@settings(deadline=None, max_examples=200)
@given(DAYS, st.integers(0, 150), st.sets(DAYS, max_size=4))
def test_pieces_cover_every_day_once(first, size, changed):
    last = first + timedelta(days=size)
    found = rollups.pieces(first, last, changed)
    covered = found["day"] + [one for level in rollups.LEVELS for start in found[level] for one in rollups.days_of(level, start)]
    assert sorted(covered) == [first + timedelta(days=n) for n in range(size + 1)]
    assert not changed & ({*covered} - {*found["day"]})


def test_a_year_is_few_pieces():
    found = rollups.pieces(day("2023-01-01"), day("2024-01-10"))
    assert (len(found["month"]), found["week"], len(found["day"])) == (12, [day("2024-01-01")], 3)
    assert rollups.pieces(day("2024-01-02"), day("2024-01-01")) == {"month": [], "week": [], "day": []}


VISITS = [
    (f"C{n % 3}", f"M{n}", app, 100 * n + 7, str(day("2024-01-01") + timedelta(days=8 * n)))
    for n in range(10) for app in ("VOD", "KPLUS", "CHANNEL")[: 1 + n % 3]
]


@pytest.fixture
def root(spark, staged, tmp_path):
    stores = pipeline.stores(spark, str(tmp_path))
    wh.load_warehouse(spark, staged(*VISITS), stores[0])
    mart.load_mart(spark, *stores)
    pipeline.refresh_rollups(spark, str(tmp_path))
    return str(tmp_path)


def load(spark, staged, root, logs, *dates):
    store, marts = pipeline.stores(spark, root)
    wh.load_warehouse(spark, staged(*logs), store, process_dates=[day(one) for one in dates])
    mart.catch_up(spark, store, marts)


def assert_exact(spark, root, first, last):
    (store, marts), rolled = pipeline.stores(spark, root), pipeline.rolled_up(spark, root)
    whole = marts.read(mart.ANALYTICS).where(F.col("DateValue").between(first, last))
    assert values(report.leaderboard(rollups.contract_window(marts, rolled, first, last))) == values(report.leaderboard(whole))
    assert values(report.details(rollups.contract_window(marts, rolled, first, last))) == values(report.details(whole))
    facts = store.read(wh.FACTS).where(F.col("DateKey").between(int(first.replace("-", "")), int(last.replace("-", ""))))
    counts = facts.agg(F.sum("TotalDuration"), F.sum("SessionCount"), F.countDistinct("ContractKey"))
    active = rollups.counted(rollups.active_window(spark, store, rolled, first, last))
    assert values(active) == values(counts)


def test_windows_are_those_of_the_days(spark, root):
    for window in (("2024-01-01", "2024-03-31"), ("2024-01-17", "2024-03-02"), ("2025-01-01", "2025-01-09")):
        assert_exact(spark, root, *window)
    # Whole months read no days.
    _, marts = pipeline.stores(spark, root)
    window = rollups.contract_window(marts, pipeline.rolled_up(spark, root), "2024-01-01", "2024-02-29")
    assert {one.split("/")[-4] for one in window.inputFiles()} == {rollups.CONTRACTS["month"]}
    assert window.count() == 6


def test_loads_the_rollups_have_not_taken_in(spark, staged, root):
    late = [*VISITS, ("C9", "M99", "VOD", 5000, "2024-02-03"), ("C0", "M98", "VOD", 5, "2024-01-02")]
    load(spark, staged, root, late, "2024-02-03", "2024-01-02")
    rolled = pipeline.rolled_up(spark, root)
    assert_exact(spark, root, "2024-01-01", "2024-03-31")
    counts = pipeline.refresh_rollups(spark, root)
    assert 0 < counts[rollups.ACTIVE["day"]] < rolled.read(rollups.ACTIVE["day"]).count()
    assert_exact(spark, root, "2024-01-01", "2024-03-31")
    assert set(pipeline.refresh_rollups(spark, root).values()) == {0}
    # A date that is emptied, also where the stores are folded before the rollups look.
    load(spark, staged, root, [one for one in late if one[4] != "2024-02-03"], "2024-02-03")
    pipeline.compact(spark, root)
    assert_exact(spark, root, "2024-01-01", "2024-03-31")
    pipeline.refresh_rollups(spark, root)
    rolled.compact()
    assert_exact(spark, root, "2024-01-01", "2024-03-31")


def test_without_rollups_days_are_read(spark, staged, tmp_path):
    stores = pipeline.stores(spark, str(tmp_path))
    assert_exact(spark, str(tmp_path), "2024-01-01", "2024-01-31")
    assert set(pipeline.refresh_rollups(spark, str(tmp_path)).values()) == {0}
    wh.load_warehouse(spark, staged(*VISITS), stores[0])
    mart.load_mart(spark, *stores)
    assert_exact(spark, str(tmp_path), "2024-01-01", "2024-01-31")


def test_states_of_files_unite_exactly(spark):
    """Keys on both sides of a bitmap's end, the same contract in several files, and a file that is replaced."""
    def sessions(file, *keys):
        return [(file, "VOD", key, 10, 1) for key in keys]

    def state(*sessions):
        frame = spark.createDataFrame(
            [*sessions], "File string, Type string, ContractKey bigint, TotalDuration bigint, SessionCount bigint")
        return rollups.active_state(frame, "File", "Type")

    first = state(*sessions("a", 1, 1, 32768, 32769), *sessions("b", 1, 2, 70000), *sessions("c", 32769))
    assert values(rollups.counted(first, "Type")) == [("VOD", 80, 8, 5)]
    again = first.where("File <> 'b'").unionByName(state(*sessions("b", 3)))
    assert values(rollups.counted(again, "Type")) == [("VOD", 60, 6, 4)]
    assert values(rollups.counted(again.where("false"), "Type")) == []


def test_weeks_and_months_from_one_pass(spark, root):
    """Both are those of the days, with the largest texts and NULLs; the days are shuffled once, no row is sorted."""
    days = pipeline.stores(spark, root)[1].read(mart.ANALYTICS)
    extra = days.limit(1).select(*[
        F.lit(None).cast("string").alias(name) if name in ("MostWatchContentType", "ActivationLevel") else F.col(name)
        for name in days.columns]).withColumn("ContractID", F.lit("C-none"))
    plan = rollups.contract_periods(days)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortAggregate" not in plan
    days = days.unionByName(extra)
    found = rollups.contract_periods(days)
    names = [name for name in found.columns if name not in ("Level", "PeriodStart", "ContractID")]
    for level in rollups.LEVELS:
        largest = ("MostWatchContentType", "ActivationDays", "ActivationLevel")
        wanted = days.groupBy(F.trunc("DateValue", level), "ContractID").agg(
            *[(F.max if name in largest else F.sum)(name) for name in names])
        got = found.where(F.col("Level") == level).select("PeriodStart", "ContractID", *names)
        assert values(got) == values(wanted)


def test_a_text_without_a_place_is_no_silent_loss(spark, root):
    days = pipeline.stores(spark, root)[1].read(mart.ANALYTICS).withColumn("ActivationLevel", F.lit("other"))
    with pytest.raises(Exception, match="unknown ActivationLevel: other"):
        rollups.merged_contracts(days, "ContractID").collect()


def test_trend_of_dense_keys_shuffles_no_contract(spark, root):
    facts, small = pipeline.stores(spark, root)[0].read(wh.FACTS), wh.SmallDims.build(spark)
    found = mart.keyed_trend(facts, small)
    assert values(found) == values(mart.content_type_trend(mart.trend_rows(facts, small))) != []
    shuffled = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning" in line]
    assert shuffled and not any("ContractKey" in line for line in shuffled)

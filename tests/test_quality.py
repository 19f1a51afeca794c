from __future__ import annotations

import pytest
from conftest import day, values

from viewlog.operators import aggregates
from viewlog.plans import dims, quality
from viewlog.plans.warehouse import SmallDims

LOGS = (
    ("C1", "M1", "VOD", 100, "2024-01-01"),
    ("C1", "M1", "VOD", 100, "2024-01-01"),
    ("C2", "M2", "NOPE", 1, "2024-01-01"),
    ("C3", "M1", "SPORT", 1, "2035-01-01"),
    (None, "M1", "SPORT", 1, "2024-01-02"),
    ("C1", None, "SPORT", 1, "2024-01-02"),
    ("C1", "M9", None, None, None),
)


@pytest.fixture
def logs(staged):
    return staged(*LOGS)


@pytest.fixture(scope="module")
def small(spark):
    return SmallDims.build(spark)


@pytest.fixture
def tables(spark, logs):
    """Dimensions that know C1, C2, M1 and M2 only."""
    contracts = spark.createDataFrame([(1, "C1"), (2, "C2")], "ContractKey long, ContractID string")
    devices = spark.createDataFrame([(1, "M1", 1), (2, "M2", 2)], "DeviceKey long, MacAddress string, ContractKey long")
    return contracts, devices


def test_profiles(logs):
    assert values(quality.staging_profile(logs)) == [(7, day("2024-01-01"), day("2035-01-01"), 3)]
    assert values(quality.day_profile(logs, "2024-01-01")) == [(3, 2, 2)]
    assert values(quality.complete_rows(logs, "2024-01-02")) == [(0,)]
    assert values(quality.complete_rows(logs, None)) == [(4,)]


def test_matches_against_the_small_dimensions(logs, small):
    assert values(quality.app_match(logs, small)) == [(3, 2, 2)]
    assert values(quality.category_match(logs, small)) == [(2, 2, 2)]
    assert values(quality.date_match(logs, small)) == [(3, 2, 2)]


def test_joinable_and_unjoinable_rows_add_up(logs, small, tables):
    grain = aggregates.session_grain(logs)
    assert values(quality.joinable_rows(grain, small, *tables)) == [(2,)]
    got = quality.unjoinable(grain, small, *tables).first().asDict()
    assert got == {"RowsCannotJoin": 5, "MissingDates": 1, "MissingContracts": 1, "MissingDevices": 1,
                   "MissingApps": 1, "MissingContentTypes": 0}


def test_joinable_rows_of_nothing(logs, small, tables):
    grain = aggregates.session_grain(logs.where("false"))
    assert values(quality.joinable_rows(grain, small, *tables)) == [(0,)]
    assert quality.unjoinable(grain, small, *tables).first().RowsCannotJoin == 0


def test_top_apps_are_ordered_with_a_tie_break(logs, small):
    got = [tuple(r) for r in quality.top_apps(logs, small, 3).collect()]
    assert got == [("SPORT", "Thể Thao", 3), ("VOD", "Phim Truyện", 2), (None, None, 1)]


def test_new_keys(logs, tables):
    assert values(quality.new_keys(logs, *tables, None)) == [(1, 1)]
    assert values(quality.new_keys(logs, *tables, "2024-01-01")) == [(0, 0)]


def test_violations_are_found(spark, small, tables):
    contracts, devices = tables
    twice = contracts.unionByName(contracts)
    assert values(quality.duplicates(twice, "ContractID", "c")) == [("c", 2)]
    lost = spark.createDataFrame([(1,), (5,), (5,), (6,)], "ContractKey long")
    assert values(quality.orphans(lost, "f", {}, {"ContractKey": contracts})) == [("f.ContractKey", 3)]
    wide = spark.createDataFrame([(1, 1), (5, 1), (None, 9), (1, 1)], "ContractKey long, AppKey int")
    apps = spark.createDataFrame([(1,)], "AppKey int")
    assert values(quality.orphans(wide, "w", {"AppKey": apps}, {"ContractKey": contracts})) == [
        ("w.AppKey", 1), ("w.ContractKey", 2)]
    holes = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert values(quality.missing_values(holes, "t", "a", "b")) == [("t.a", 1), ("t.b", 2)]


def test_a_clean_load_has_no_violations(logs, small, spark):
    grain = aggregates.session_grain(logs)
    contracts = dims.new_contracts(grain)
    owned = dims.owned_pairs(grain, contracts)
    devices = dims.new_devices(owned)
    daily = spark.createDataFrame([(day("2024-01-01"),)], "DateValue date")
    checks = quality.unique_checks(small, contracts, devices, daily)
    assert {violations for _, violations in values(checks)} == {0}
    assert values(quality.orphans(devices, "d", {}, {"ContractKey": contracts})) == [("d.ContractKey", 0)]

from __future__ import annotations

import pytest
from conftest import SF_DIR, day, values
from pyspark.sql import functions as F

from viewlog.operators import aggregates, rows
from viewlog.plans import dims, mart, pipeline
from viewlog.plans import warehouse as wh
from viewlog.sources import adapter

LOGS = (
    ("C1", "M1", "VOD", 100, "2024-01-01"),
    ("C1", "M1", "VOD", 50, "2024-01-01"),
    ("C1", "M2", "CHANNEL", None, "2024-01-01"),
    ("C2", "M1", "SPORT", 30, "2024-01-01"),
    ("C2", "M3", "OTHER", 70, "2024-01-02"),
    ("C2", "M3", None, 5, "2024-01-02"),
    ("C3", None, "VOD", 9, "2024-01-02"),
    (None, "M4", "VOD", 9, "2024-01-02"),
    ("C4", "M5", "CHILD", 40, "2019-12-31"),
    ("C4", "M5", "CHILD", 41, "2024-01-02"),
)


@pytest.fixture
def store(spark, tmp_path):
    return wh.warehouse_store(spark, str(tmp_path / "warehouse"))


@pytest.fixture(scope="module")
def events(spark):
    return adapter.staging_from_events(spark, SF_DIR)


def named_facts(store):
    return (
        store.read(wh.FACTS).join(store.read(wh.CONTRACTS), "ContractKey")
        .join(store.read(wh.DEVICES).drop("ContractKey"), "DeviceKey")
        .select("DateKey", "ContractID", "MacAddress", "AppKey", "ContentTypeKey", "TotalDuration", "SessionCount")
    )


def test_facts_of_hand_rows(spark, staged, store):
    counts = wh.load_warehouse(spark, staged(*LOGS), store)
    assert counts == {
        wh.CONTRACTS: 4, wh.DEVICES: 4, wh.FACTS: 4, wh.SUMMARY: 3, wh.FIRST: 3,
        "TurnedAwayDate": 1, "TurnedAwayApp": 2, "TurnedAwayContract": 1, "TurnedAwayDevice": 1}
    assert values(named_facts(store)) == sorted([
        (20240101, "C1", "M1", 5, 2, 150, 2), (20240101, "C1", "M2", 1, 1, 0, 1),
        (20240101, "C2", "M1", 14, 5, 30, 1), (20240102, "C4", "M5", 13, 4, 41, 1)])
    summary = store.read(wh.SUMMARY).join(store.read(wh.CONTRACTS), "ContractKey")
    assert values(summary, "DateKey", "ContractID", "TotalDevices", "TotalDuration_PhimTruyen",
                  "TotalDuration_Error", "TotalDuration_All") == [
        (20240101, "C1", 2, 150, 0, 150), (20240101, "C2", 1, 0, 0, 30), (20240102, "C4", 1, 0, 0, 41)]


def test_shared_device_belongs_to_the_smallest_contract_key(spark, staged, store):
    wh.load_warehouse(spark, staged(*LOGS), store)
    contracts = {name: key for key, name in values(store.read(wh.CONTRACTS), "ContractKey", "ContractID")}
    owners = dict(values(store.read(wh.DEVICES), "MacAddress", "ContractKey"))
    assert owners["M1"] == min(contracts["C1"], contracts["C2"])
    assert set(owners) == {"M1", "M2", "M3", "M5"}


def test_unknown_apps_can_be_kept(spark, staged, store):
    wh.load_warehouse(spark, staged(*LOGS), store, unknown="error")
    unknown = named_facts(store).where("AppKey = 0")
    assert values(unknown, "ContractID", "MacAddress", "ContentTypeKey", "TotalDuration", "SessionCount") == [
        ("C2", "M3", 6, 75, 2)]
    total = store.read(wh.SUMMARY).agg(F.sum("TotalDuration_Error")).first()[0]
    assert total == 75
    with pytest.raises(ValueError):
        wh.load_warehouse(spark, staged(*LOGS), store, unknown="maybe")


def test_loading_again_changes_nothing(spark, events, store):
    wh.load_warehouse(spark, events, store)
    first = {name: values(store.read(name)) for name in store.tables}
    again = wh.load_warehouse(spark, events, store)
    assert again[wh.CONTRACTS] == again[wh.DEVICES] == 0
    wh.load_warehouse(spark, events, store, process_date="2024-01-16")
    assert {name: values(store.read(name)) for name in store.tables} == first


def test_a_date_at_a_time_equals_all_at_once(spark, events, tmp_path):
    whole, marts = pipeline.stores(spark, str(tmp_path / "all"))
    parts, part_marts = pipeline.stores(spark, str(tmp_path / "daily"))
    some = rows.between(events, "2024-01-01", "2024-01-02", "EventDate").cache()
    wh.load_warehouse(spark, some, whole)
    mart.load_mart(spark, whole, marts)
    for text in ("2024-01-01", "2024-01-02"):
        wh.load_warehouse(spark, some, parts, process_date=text)
        mart.load_mart(spark, parts, part_marts, process_date=text)
    assert values(named_facts(whole)) == values(named_facts(parts))
    for name in (mart.ANALYTICS, mart.DAILY, mart.TREND):
        assert values(marts.read(name)) == values(part_marts.read(name)), name
    some.unpersist()


def test_device_keeps_its_first_contract(spark, staged, store):
    wh.load_warehouse(spark, staged(("C9", "M1", "VOD", 1, "2024-01-01")), store)
    more = staged(("C9", "M1", "VOD", 1, "2024-01-01"), ("C0", "M1", "VOD", 1, "2024-01-02"),
                  ("C0", "M2", "VOD", 1, "2024-01-02"))
    wh.load_warehouse(spark, more, store)
    assert values(store.read(wh.CONTRACTS)) == [(1, "C9"), (2, "C0")]
    assert values(store.read(wh.DEVICES)) == [(1, "M1", 1), (2, "M2", 2)]


def test_an_unpublished_run_stays_invisible_and_is_replaced(spark, staged, store, monkeypatch):
    wh.load_warehouse(spark, staged(LOGS[0]), store)
    before = {name: values(store.read(name)) for name in store.tables}

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(wh, "fact_contract_summary", fail)
        with pytest.raises(RuntimeError):
            wh.load_warehouse(spark, staged(*LOGS), store)
    assert {name: values(store.read(name)) for name in store.tables} == before
    wh.load_warehouse(spark, staged(*LOGS), store)
    assert store.read(wh.FACTS).count() == 4 and store.read(wh.CONTRACTS).count() == 4


def test_other_dates_survive_a_date_load(spark, staged, store):
    wh.load_warehouse(spark, staged(*LOGS), store)
    changed = staged(("C1", "M1", "VOD", 999, "2024-01-02"))
    wh.load_warehouse(spark, changed, store, process_date="2024-01-02")
    sums = dict(values(store.read(wh.FACTS).groupBy("DateKey").agg(F.sum("TotalDuration"))))
    assert sums == {20240101: 180, 20240102: 999}
    wh.load_warehouse(spark, changed.where("false"), store, process_date="2024-01-02")
    assert values(store.read(wh.FACTS).select("DateKey").distinct()) == [(20240101,)]


def test_empty_staging_gives_empty_tables(spark, staged, store):
    assert store.read(wh.FACTS).count() == 0
    counts = wh.load_warehouse(spark, staged(*LOGS).where("false"), store)
    assert set(counts.values()) == {0} and store.read(wh.SUMMARY).count() == 0


def test_sessions_and_seconds_agree_across_tables(spark, events, tmp_path):
    store, marts = pipeline.stores(spark, str(tmp_path))
    wh.load_warehouse(spark, events, store)
    mart.load_mart(spark, store, marts)
    facts, summary = store.read(wh.FACTS), store.read(wh.SUMMARY)
    joinable = mart.known_logs(events)
    seconds = joinable.agg(F.sum("TotalDuration")).first()[0]
    assert facts.agg(F.sum("SessionCount"), F.sum("TotalDuration")).first()[:] == (joinable.count(), seconds)
    wide = [F.col(n) for n in summary.columns if n.startswith("TotalDuration_") and not n.endswith("All")]
    assert summary.where(sum(wide[1:], wide[0]) != F.col("TotalDuration_All")).count() == 0
    for name, column in ((mart.ANALYTICS, "Duration_Total"), (mart.DAILY, "TotalDuration_All"),
                         (mart.TREND, "TotalDuration")):
        assert marts.read(name).agg(F.sum(column)).first()[0] == seconds


def test_facts_shuffle_sessions_by_pair_once(spark, events):
    """The join of the sessions is on contract and device together, after pre-aggregation."""
    grain = aggregates.session_grain(events)
    contracts = dims.new_contracts(grain)
    owned = dims.owned_pairs(grain, contracts)
    facts = wh.fact_viewing_session(grain, wh.SmallDims.build(spark), dims.pair_keys(owned, dims.new_devices(owned)))
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner, ((Contract" in plan and "Cartesian" not in plan


def test_date_filter_prunes_partitions(spark, staged, store):
    wh.load_warehouse(spark, staged(*LOGS), store)
    chosen = store.read(wh.FACTS).where("DateKey = 20240101")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "20240101" in plan.split("PartitionFilters")[1]
    assert len(chosen.inputFiles()) >= 1


def test_load_dates_as_date_or_text(spark, staged, store):
    wh.load_warehouse(spark, staged(*LOGS), store, process_date=day("2024-01-01"))
    assert store.read(wh.FACTS).count() == 3
    with pytest.raises(ValueError):
        wh.load_warehouse(spark, staged(*LOGS), store, process_date="01/02/2024")


def test_a_longer_calendar_and_what_is_turned_away(spark, staged, tmp_path):
    logs = staged(
        ("C1", "M1", "VOD", 10, "2024-01-01"), ("C1", "M1", "VOD", 10, "2031-05-05"), ("C1", None, "VOD", 10, "2024-01-01"),
        ("C1", "M1", "NOPE", 10, "2024-01-01"), (None, "M1", "VOD", 10, "2024-01-01"), ("C1", "M1", "VOD", 10, None))
    counts = wh.load_warehouse(spark, logs, wh.warehouse_store(spark, str(tmp_path / "a")))
    assert {name: count for name, count in counts.items() if name.startswith("TurnedAway")} == {
        "TurnedAwayDate": 2, "TurnedAwayApp": 1, "TurnedAwayContract": 1, "TurnedAwayDevice": 1}
    store = wh.warehouse_store(spark, str(tmp_path / "b"))
    counts = wh.load_warehouse(spark, logs, store, calendar=("2020-01-01", "2035-12-31"))
    assert counts["TurnedAwayDate"] == 1 and counts[wh.FACTS] == 2
    assert 20310505 in {row.DateKey for row in store.read(wh.FACTS).collect()}


def test_dimensions_need_the_pairs_only(spark, staged):
    """A contract without a device is a member; a row without a contract brings none."""
    logs = staged(
        ("C1", "M1", "VOD", 5, "2024-01-01"), ("C1", "M1", "CHILD", 5, "2024-01-02"), ("C2", None, "VOD", 5, "2024-01-01"),
        (None, "M2", "VOD", 5, "2024-01-01"), ("C3", "M1", None, None, None))
    seen = dims.seen_pairs(logs)
    assert values(seen) == [("C1", "M1"), ("C2", None), ("C3", "M1")]
    contracts = dims.new_contracts(logs)
    assert values(dims.new_contracts(seen)) == values(contracts)
    assert values(dims.owned_pairs(seen, contracts)) == values(dims.owned_pairs(logs, contracts))

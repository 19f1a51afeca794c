"""Publishing side by side, audited loads, snapshots, the feed of changes and the journal."""

from __future__ import annotations

from types import SimpleNamespace

import pytest
from conftest import day, values

from viewlog.plans import mart, pipeline
from viewlog.plans import warehouse as wh
from viewlog.plans.journal import Journal
from viewlog.schema import columns
from viewlog.sinks import files
from viewlog.sinks.commits import CommitLog, Taken
from viewlog.sinks.versioned import Refused, Rule, RulesBroken, SnapshotGone, Stale, Table, VersionedStore, given

DATED = Table("t", columns(DateKey="int", n="bigint"), dated_by="DateKey", rules=given("n"))
GROWING = Table("m", columns(Key="bigint", Name="string"), key="Key", unique=("Name",))
LINKED = Table("l", columns(DateKey="int", Key="bigint"), dated_by="DateKey", references=(("Key", "m"),))


def begun(store, *lines):
    run = store.begin()
    run.write("t", store.spark.createDataFrame([(int(d.replace("-", "")), n) for d, n in lines], DATED.layout))
    return run


def days_of(*texts):
    return [day(text) for text in texts]


# --- The log --------------------------------------------------------------------------------------


@pytest.mark.parametrize("renamed", [False, True])
def test_an_entry_is_created_once(spark, tmp_path, renamed, monkeypatch):
    log = CommitLog(spark, str(tmp_path / "log"))
    if renamed:  # as on a file system without links
        take = log._take
        monkeypatch.setattr(log, "_take", lambda files, own, final: take(SimpleNamespace(
            getScheme=lambda: "other", getUri=files.getUri, exists=files.exists), own, final))
    assert log.numbers() == []
    log.append(1, {"a": [1, None]})
    with pytest.raises(Taken):
        log.append(1, {"a": 2})
    log.append(2, {"b": "ü"})
    assert log.numbers() == [1, 2] and log.entry(1) == {"a": [1, None]} and log.entry(2) == {"b": "ü"}
    assert sorted(path.name for path in (tmp_path / "log").iterdir() if path.suffix != ".crc") == ["000000000001", "000000000002"]


# --- Several writers ------------------------------------------------------------------------------


def test_loads_of_different_dates_at_once_both_stay(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path), [DATED])
    first, second, third = (begun(store, (d, n)) for d, n in (("2024-01-01", 1), ("2024-01-02", 2), ("2024-01-01", 3)))
    assert len({first.number, second.number, third.number}) == 3
    second.publish(replaces=days_of("2024-01-02"))
    first.publish(replaces=days_of("2024-01-01"))
    with pytest.raises(Refused):
        third.publish(replaces=days_of("2024-01-01"))
    with pytest.raises(Refused):
        third.publish()
    assert values(store.read("t"), "n") == [(1,), (2,)]
    begun(store, ("2024-01-01", 4)).publish(replaces=days_of("2024-01-01"))
    assert values(store.read("t"), "n") == [(2,), (4,)]


def test_folding_gives_way_to_a_load(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path), [DATED])
    begun(store, ("2024-01-01", 1)).publish(replaces=days_of("2024-01-01"))
    late = begun(store, ("2024-01-02", 2))
    folding = begun(store, ("2024-01-01", 1))
    late.publish(replaces=days_of("2024-01-02"))
    with pytest.raises(Stale):
        folding.publish(compacted=True)
    before = begun(store, ("2024-01-03", 3))
    store.compact()
    before.publish(replaces=days_of("2024-01-03"))  # folding changes nothing that it could contradict
    assert values(store.read("t"), "n") == [(1,), (2,), (3,)]


def test_a_store_that_grows_begins_again(spark, staged, tmp_path):
    store = wh.warehouse_store(spark, str(tmp_path))
    logs = staged(("C1", "M1", "VOD", 1, "2024-01-01"), ("C2", "M2", "VOD", 1, "2024-01-02"))
    attempts, write = [], VersionedStore.begin

    def begin(self):
        run = write(self)
        if not attempts:  # while the first attempt is at work, another load is published
            attempts.append(run.number)
            wh.load_warehouse(spark, logs, wh.warehouse_store(spark, str(tmp_path)), "2024-01-02")
        return run

    store.begin = begin.__get__(store)
    wh.load_warehouse(spark, logs, store, "2024-01-01")
    assert values(store.read(wh.CONTRACTS)) == [(1, "C2"), (2, "C1")]
    assert values(store.read(wh.FACTS), "DateKey", "ContractKey") == [(20240101, 2), (20240102, 1)]
    attempts.clear()
    with pytest.raises(Refused):
        wh.load_warehouse(spark, logs, store, "2024-01-02")


# --- Audit ----------------------------------------------------------------------------------------


def test_a_load_that_breaks_a_rule_stays_invisible(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path), [DATED])
    begun(store, ("2024-01-01", 1)).publish(replaces=days_of("2024-01-01"))
    run = begun(store, ("2024-01-01", None), ("2024-01-01", 5))
    with pytest.raises(RulesBroken, match="n is given") as refused:
        run.publish(replaces=days_of("2024-01-01"))
    assert refused.value.broken == {("t", "n is given"): 1}
    assert values(store.read("t"), "n") == [(1,)]


@pytest.mark.parametrize("members, links, broken", [
    ([(1, "a"), (2, "b")], [1, 2, 2], {}),
    ([(1, "a"), (2, "b")], [3, 0, None], {("l", "Key is in m"): 3}),
    ([(1, "a"), (3, "b")], [1], {("m", "Key goes on without gaps"): 2}),
    ([(1, "a"), (2, "a")], [1], {("m", "Name occurs once"): 1}),
])
def test_keys_are_audited_without_a_join(spark, tmp_path, members, links, broken):
    store = VersionedStore(spark, str(tmp_path), [GROWING, LINKED])
    run = store.begin()
    run.write("m", spark.createDataFrame(members, GROWING.layout))
    run.write("l", spark.createDataFrame([(20240101, key) for key in links], LINKED.layout))
    assert run.broken == broken
    if broken:
        return
    run.publish()
    more = store.begin()
    more.write("m", spark.createDataFrame([(3, "c")], GROWING.layout))
    more.write("l", spark.createDataFrame([(20240102, 3), (20240102, 1)], LINKED.layout))
    assert more.broken == {}


def test_rules_of_ones_own(spark, staged, tmp_path):
    rules = {wh.FACTS: (Rule("an hour at most", "TotalDuration <= 3600"),)}
    store = wh.warehouse_store(spark, str(tmp_path), rules)
    with pytest.raises(RulesBroken, match="an hour at most"):
        wh.load_warehouse(spark, staged(("C1", "M1", "VOD", 4000, "2024-01-01")), store)
    assert store.position() == 0 and store.read(wh.CONTRACTS).count() == 0
    wh.load_warehouse(spark, staged(("C1", "M1", "VOD", 400, "2024-01-01")), store)
    assert store.position() == 1


# --- Snapshots ------------------------------------------------------------------------------------


def test_a_snapshot_outlives_a_load_and_a_compaction(spark, tmp_path):
    store = VersionedStore(spark, str(tmp_path), [DATED])
    empty = store.snapshot()
    begun(store, ("2024-01-01", 1)).publish(replaces=days_of("2024-01-01"))
    one = store.snapshot()
    begun(store, ("2024-01-01", 2)).publish(replaces=days_of("2024-01-01"))
    two = store.snapshot()
    store.compact(retain=2)
    assert [values(s.read("t"), "n") for s in (empty, one, two, store)] == [[], [(1,)], [(2,)], [(2,)]]
    begun(store, ("2024-01-01", 3)).publish(replaces=days_of("2024-01-01"))
    store.compact()
    assert values(store.read("t"), "n") == [(3,)]
    for gone in (one, two):
        with pytest.raises(SnapshotGone):
            gone.read("t")
    same = store.snapshot()
    store.compact()
    assert values(same.read("t"), "n") == [(3,)]  # the content is the same, whoever wrote it


# --- Changes the marts take in --------------------------------------------------------------------


VISITS = [("C1", "M1", "VOD", 5, f"2024-01-{n:02d}") for n in (1, 2, 4, 10)]


def activation(marts):
    return values(marts.read(mart.ANALYTICS), "DateValue", "ActivationDays")


@pytest.mark.parametrize("fold", [False, True])
def test_two_warehouse_loads_before_one_mart_load(spark, staged, tmp_path, fold):
    store, marts = pipeline.stores(spark, str(tmp_path))
    logs = staged(*VISITS, ("C2", "M2", "VOD", 5, "2024-01-04"))
    for one in ("2024-01-10", "2024-01-04"):
        wh.load_warehouse(spark, logs, store, one)
    mart.catch_up(spark, store, marts)
    wh.load_warehouse(spark, logs, store, "2024-01-02")  # moves C1
    if fold:
        store.compact()
        marts.compact()
    wh.load_warehouse(spark, logs, store, "2024-01-01")  # and again
    wh.load_warehouse(spark, logs, store, "2024-01-04")  # moves nothing
    assert mart.pending_dates(store, marts) == days_of("2024-01-01", "2024-01-02", "2024-01-04", "2024-01-10")
    mart.load_mart(spark, store, marts, "2024-01-01")  # holds too little to count as caught up
    assert mart.pending_dates(store, marts) == days_of("2024-01-01", "2024-01-02", "2024-01-04", "2024-01-10")
    mart.catch_up(spark, store, marts)
    wanted = [(day("2024-01-01"), 1), (day("2024-01-02"), 2), (day("2024-01-04"), 1), (day("2024-01-04"), 4), (day("2024-01-10"), 10)]
    assert activation(marts) == wanted
    assert mart.pending_dates(store, marts) == [] and set(mart.catch_up(spark, store, marts).values()) == {0}


# --- The journal ----------------------------------------------------------------------------------


def test_journal_hands_on_what_was_not_ended(spark, tmp_path):
    journal = Journal(spark, str(tmp_path))
    assert journal.unfinished() == [] and journal.committed() is None
    assert journal.begin(days_of("2024-01-02")) == days_of("2024-01-02")
    assert journal.begin(days_of("2024-01-01")) == days_of("2024-01-01", "2024-01-02")
    journal.end(warehouse=3)
    assert journal.unfinished() == [] and journal.committed() == {"warehouse": 3}
    journal.begin(None)
    assert journal.begin(days_of("2024-01-01")) is None and journal.committed() == {"warehouse": 3}


@pytest.mark.parametrize("step, after", [
    ("load_warehouse", True), ("load_media_report", False), ("catch_up", False), ("catch_up", True)])
def test_a_refresh_that_failed_anywhere_is_made_good(spark, staged, tmp_path, monkeypatch, step, after):
    root = str(tmp_path)
    logs = staged(("C1", "M1", "VOD", 5, "2024-01-10"), ("C1", "M1", "VOD", 7, "2024-01-01"), ("C3", "M3", "SPORT", 9, "2024-01-05"))
    files.append_staging(logs, pipeline.staging_folder(root), "all")
    pipeline.refresh(spark, root, days_of("2024-01-10"))
    owner = wh if step == "load_warehouse" else mart
    work = getattr(owner, step)

    def fail(*args, **named):
        if after:
            work(*args, **named)
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(owner, step, fail)
        with pytest.raises(RuntimeError, match="lost"):
            pipeline.refresh(spark, root, days_of("2024-01-01"))
    # Readers of what is committed see none of it.
    assert values(pipeline.committed(spark, root)[0].read(wh.FACTS), "DateKey") == [(20240110,)]
    assert activation(pipeline.committed(spark, root)[1]) == [(day("2024-01-10"), 1)]
    pipeline.refresh(spark, root, days_of("2024-01-05"))  # another night, other dates
    store, marts, media = pipeline.committed(spark, root)
    assert activation(marts) == [(day("2024-01-01"), 1), (day("2024-01-05"), 1), (day("2024-01-10"), 10)]
    assert values(store.read(wh.FACTS), "DateKey", "TotalDuration") == [(20240101, 7), (20240105, 9), (20240110, 5)]
    assert values(media.read(mart.MEDIA), "ReportDate", "TotalDuration") == [
        (day("2024-01-01"), 7), (day("2024-01-05"), 9), (day("2024-01-10"), 5)]


def test_what_is_committed_stays_readable_through_folding(spark, staged, tmp_path):
    root = str(tmp_path)
    files.append_staging(staged(*VISITS), pipeline.staging_folder(root), "all")
    pipeline.refresh(spark, root, None)
    pipeline.compact(spark, root)
    store, marts, media = pipeline.committed(spark, root)
    assert len(activation(marts)) == 4 and store.read(wh.FACTS).count() == 4 and media.read(mart.MEDIA).count() == 4

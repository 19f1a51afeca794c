from __future__ import annotations

import json

import pytest
from conftest import day, values
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from viewlog.operators import rows
from viewlog.plans import pipeline
from viewlog.sinks import files
from viewlog.sources import landing


def record(contract, mac="M1", app="VOD", seconds=60, **extra):
    return {"_index": "x", "_source": {"Contract": contract, "Mac": mac, "AppName": app, "TotalDuration": seconds, **extra}}


@pytest.fixture
def folder(tmp_path):
    def put(name, *lines):
        (tmp_path / name).write_text("".join((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines))

    put("20220401.json", record("C1"), record("C2", Date="20220331"))
    put("20220402.json", record("C1", Date="zz"), "{broken")
    put("20220404.json", record("C3", Date="2022-04-04"))
    put("notes.json", record("C9"))
    put("readme.txt", record("C8"))
    return tmp_path


def test_one_file_has_the_fixed_columns(spark, folder):
    flat = rows.flatten(landing.read_file(spark, f"{folder}/20220401.json"))
    assert flat.columns == ["Contract", "Mac", "AppName", "TotalDuration", "Date"]
    assert values(flat, "Contract", "Date") == [("C1", None), ("C2", "20220331")]


def test_many_files_need_at_least_one(spark, folder):
    with pytest.raises(ValueError):
        landing.read_files(spark, [])
    raw = landing.read_files(spark, [f"{folder}/20220401.json", f"{folder}/20220404.json"])
    assert raw.count() == 3


def test_folder_takes_json_files_only(spark, folder):
    assert landing.read_folder(spark, str(folder)).count() == 6
    with pytest.raises(ValueError):
        landing.read_folder(spark, f"{folder}/missing")


def test_date_range_skips_missing_days(spark, folder):
    assert landing.read_date_range(spark, str(folder), "20220401", "20220403").count() == 4
    assert landing.read_date_range(spark, str(folder), "20220404", "20220401").count() == 0
    assert landing.read_date_range(spark, str(folder), "20230101", "20230102").count() == 0
    with pytest.raises(ValueError):
        landing.read_date_range(spark, str(folder), "2022-04-01", "20220402")
    assert landing.days_between("20220228", "20220301") == ["20220228", "20220301"]


def test_undated_files_are_left_out(spark, folder):
    dated = landing.with_name_date(landing.read_folder(spark, str(folder)))
    good = dated.where("_source IS NOT NULL")
    assert values(rows.flatten(good), "Contract", "DateValue") == [
        ("C1", "20220401"), ("C1", "20220402"), ("C2", "20220401"), ("C3", "20220404")]


def test_event_date_falls_back_to_name_then_run_date(spark, folder):
    raw = landing.read_folder(spark, str(folder))
    named = rows.staging_rows(landing.with_name_date(raw))
    assert values(named, "Contract", "EventDate") == [
        ("C1", day("2022-04-01")), ("C1", day("2022-04-02")), ("C2", day("2022-03-31")), ("C3", day("2022-04-04"))]
    plain = rows.staging_rows(raw, run_date="2022-05-01")
    assert ("C1", day("2022-05-01")) in values(plain, "Contract", "EventDate")


def test_bad_lines_are_counted_and_dropped(spark, folder):
    raw = landing.read_file(spark, f"{folder}/20220402.json")
    assert landing.bad_lines(raw).first().asDict() == {"Lines": 2, "BadLines": 1, "BadDurations": 0}
    assert rows.staging_rows(raw).count() == 1


def test_durations_of_any_form(spark, tmp_path):
    (tmp_path / "20220401.json").write_text("".join(json.dumps(record(f"C{n}", seconds=value)) + "\n" for n, value in enumerate(
        [12.5, "77", "8.9", 0, -3.9, None, "much", 1e3, True])))
    report = pipeline.load_staging(spark, [f"{tmp_path}/20220401.json"], f"{tmp_path}/s")
    assert report == {"Lines": 9, "BadLines": 0, "BadDurations": 2, "Skipped": []}
    found = dict(values(files.read_staging(spark, f"{tmp_path}/s"), "Contract", "TotalDuration"))
    assert [found[f"C{n}"] for n in range(9)] == [12, 77, 8, 0, -3, None, None, 1000, None]


def test_broken_and_missing_files(spark, tmp_path):
    import gzip

    def zipped(name, *contracts):
        data = gzip.compress("".join(json.dumps(record(c)) + "\n" for c in contracts).encode(), 1)
        (tmp_path / name).write_bytes(data)
        return data

    zipped("20220401.json.gz", "C1")
    half = zipped("20220402.json.gz", *[f"D{n * 7919 % 100003}" for n in range(5000)])
    (tmp_path / "20220402.json.gz").write_bytes(half[:len(half) // 2])
    good, broken, missing = (f"{tmp_path}/{name}" for name in ("20220401.json.gz", "20220402.json.gz", "20220403.json.gz"))
    for paths in ([good, broken], [good, missing]):
        with pytest.raises((PySparkException, Py4JJavaError)):
            pipeline.load_staging(spark, paths, f"{tmp_path}/s")
        assert files.read_staging(spark, f"{tmp_path}/s").count() == 0
    with pytest.raises(PySparkException):
        pipeline.load_staging(spark, [missing, good], f"{tmp_path}/s", skip_unreadable=True)
    report = pipeline.load_staging(spark, [good, broken, missing], f"{tmp_path}/s", skip_unreadable=True)
    assert report["Skipped"] == [broken, missing]
    assert values(files.read_staging(spark, f"{tmp_path}/s"), "Contract", "EventDate") == [("C1", day("2022-04-01"))]


def test_a_file_is_replaced_whatever_it_is_loaded_with(spark, folder, tmp_path):
    root, a, b = str(tmp_path / "s"), f"{folder}/20220401.json", f"{folder}/20220404.json"
    pipeline.load_staging(spark, [a], root)
    pipeline.load_staging(spark, [a, b], root)
    assert values(files.read_staging(spark, root), "Contract", "EventDate") == [
        ("C1", day("2022-04-01")), ("C2", day("2022-03-31")), ("C3", day("2022-04-04"))]
    (folder / "20220401.json").write_text("{broken\n")
    pipeline.load_staging(spark, [a, b], root)
    assert values(files.read_staging(spark, root), "Contract") == [("C3",)]


def test_paths_of_a_range_and_of_a_folder(spark, folder):
    names = [path.rsplit("/", 1)[1] for path in landing.paths_in_range(spark, str(folder), "20220401", "20220403")]
    assert names == ["20220401.json", "20220402.json"]
    assert landing.paths_in_range(spark, str(folder), "20230101", "20230102") == []
    assert len(landing.paths_in_folder(spark, str(folder))) == 4
    paths = landing.paths_in_range(spark, str(folder), "20220401", "20220404")
    counts = pipeline.run_pipeline(spark, paths, f"{folder}/root")
    assert counts["Lines"] == 5 and counts["BadLines"] == 1 and counts["dm_daily_summary"] == 4


def test_load_staging_is_idempotent_per_file_list(spark, folder, tmp_path):
    root = str(tmp_path / "out" / "staging")
    paths = [f"{folder}/20220401.json", f"{folder}/20220402.json"]
    for _ in range(2):
        pipeline.load_staging(spark, paths, root, run_date="2022-05-01")
    assert files.read_staging(spark, root).count() == 3
    pipeline.load_staging(spark, [f"{folder}/20220404.json"], root)
    assert files.read_staging(spark, root).count() == 4


def test_load_staging_refuses_nothing(spark, folder, tmp_path):
    with pytest.raises(ValueError):
        pipeline.load_staging(spark, [], str(tmp_path / "s"))
    (folder / "20220405.json").write_text("{broken\n")
    with pytest.raises(ValueError):
        pipeline.load_staging(spark, [f"{folder}/20220405.json"], str(tmp_path / "s"))
    assert files.read_staging(spark, str(tmp_path / "s")).count() == 0


def test_profile_of_files(spark, folder):
    paths = [f"{folder}/20220401.json", f"{folder}/20220402.json"]
    profile = pipeline.profile_files(spark, paths, labels="en")
    assert values(profile, "Contract", "Movie", "TotalDevices", "ActivationDays", "ActivationLevel") == [
        ("C1", 120, 2, 2, "Low"), ("C2", 60, 1, 1, "Low")]
    undated = pipeline.profile_files(spark, paths, dated=False)
    assert "ActivationDays" not in undated.columns

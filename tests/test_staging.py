from __future__ import annotations

import json
import threading
from pathlib import Path

import pytest
from conftest import day, values
from pyspark.sql import functions as F

from viewlog.operators import rows
from viewlog.plans import pipeline
from viewlog.sinks import files
from viewlog.sources import landing


def folders(root) -> set[str]:
    return {path.name for path in Path(root).glob("load=*")}


def visible(spark, root) -> list[files.Load]:
    return files._state(files._log(spark, root))[1]


def test_one_file_loaded_many_times_keeps_one_folder(spark, staged, tmp_path):
    root = str(tmp_path)
    for n in range(5):
        files.append_staging(staged((f"C{n}", "M", "VOD", n, "2024-01-01")), root, "a", keep_hours=0)
        assert len(folders(root)) <= 2
    assert values(files.read_staging(spark, root), "Contract") == [("C4",)]
    assert len(visible(spark, root)) == 1


def test_merging_changes_no_row(spark, staged, tmp_path):
    root = str(tmp_path)
    for n in range(7):
        batch = staged((f"C{n}", "M", "VOD", n, f"2024-01-0{n + 1}"), ("shared", "M", "VOD", n, None))
        name = F.when(F.col("Contract") == "shared", "b").otherwise(F.concat(F.lit("a"), F.col("Contract")))
        files.append_staging(batch.withColumn("SourceFile", name), root, "x", fan_in=2, keep_hours=0)
        wanted = [(f"C{i}", day(f"2024-01-0{i + 1}")) for i in range(n + 1)] + [("shared", None)]
        assert values(files.read_staging(spark, root), "Contract", "EventDate") == sorted(
            wanted, key=lambda row: (row[0], str(row[1])))
    assert values(files.read_staging(spark, root).where("Contract = 'shared'"), "TotalDuration") == [(6,)]
    assert len(visible(spark, root)) <= 3 and len(folders(root)) <= 6
    assert max(one.level for one in visible(spark, root)) >= 2
    named = spark.createDataFrame([("aC3",), ("b",)], "SourceFile string")
    assert files.dates_held(spark, root, named) == [day("2024-01-04")]


def test_folders_stay_for_readers_until_their_time(spark, staged, tmp_path):
    root = str(tmp_path)
    files.append_staging(staged(("C1", "M", "VOD", 1, "2024-01-01")), root, "a")
    early = files.read_staging(spark, root)
    files.append_staging(staged(("C2", "M", "VOD", 1, "2024-01-01")), root, "a")
    assert values(early, "Contract") == [("C1",)]
    assert values(files.read_staging(spark, root), "Contract") == [("C2",)]


def test_a_large_load_is_rewritten_when_half_is_superseded(spark, staged, tmp_path):
    root = str(tmp_path)
    both = staged(("C1", "M", "VOD", 1, "2024-01-01"), ("C2", "M", "VOD", 1, "2024-01-01"))
    files.append_staging(both.withColumn("SourceFile", F.col("Contract")), root, "big")
    files.append_staging(staged(("C9", "M", "VOD", 1, "2024-01-02")), root, "C1")
    assert files.merge_staging(spark, root, settled=1) == 1
    assert files.merge_staging(spark, root, settled=1) == 0
    assert [(one.files, one.stale) for one in visible(spark, root)] == [(1, 0), (1, 0)]
    assert values(files.read_staging(spark, root), "Contract") == [("C2",), ("C9",)]


def test_writers_side_by_side_lose_nothing(spark, staged, tmp_path):
    root, failed = str(tmp_path), []

    def load(n):
        try:
            files.append_staging(staged((f"C{n}", "M", "VOD", 1, "2024-01-01")), root, f"l{n}", fan_in=2)
        except Exception as error:  # a thread would swallow it
            failed.append(error)

    threads = [threading.Thread(target=load, args=(n,)) for n in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert not failed
    assert values(files.read_staging(spark, root), "Contract") == [("C0",), ("C1",), ("C2",), ("C3",)]


def test_a_failed_load_stays_unseen(spark, staged, tmp_path, monkeypatch):
    root = str(tmp_path)
    files.append_staging(staged(("C1", "M", "VOD", 1, "2024-01-01")), root, "a")
    with monkeypatch.context() as patch, pytest.raises(RuntimeError):
        patch.setattr(files, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        files.append_staging(staged(("C2", "M", "VOD", 1, "2024-01-01")), root, "a")
    assert values(files.read_staging(spark, root), "Contract") == [("C1",)]


def test_every_line_is_staged_or_rejected(spark, tmp_path):
    good = {"_source": {"Contract": "C1", "Mac": "M", "AppName": "VOD", "TotalDuration": 5}}
    lines = [json.dumps(good), "", "  ", "{broken", "{}", "[]", '{"_source": null}', "null",
             json.dumps([good, {"x": 1}]), '{"_source": 5}']
    path = tmp_path / "20240101.json"
    path.write_text("\n".join(lines))
    report = pipeline.load_staging(spark, [str(path)], f"{tmp_path}/s")
    assert values(files.read_staging(spark, f"{tmp_path}/s"), "Contract", "EventDate") == [("C1", day("2024-01-01"))] * 2
    rejected = files.read_rejected(spark, f"{tmp_path}/s")
    assert sorted(row.Line for row in rejected.collect()) == sorted(line for line in lines[3:])
    assert {row.Line: row.Reason for row in rejected.collect()}["{broken"] == landing.NOT_JSON
    assert {row.Line: row.Reason for row in rejected.collect()}["{}"] == landing.NO_RECORD
    assert {Path(row.SourceFile).name for row in rejected.collect()} == {"20240101.json"}
    assert report["Lines"] == 9 and report["BadLines"] == 7
    path.write_text(json.dumps(good) + "\n")  # a file that is loaded again takes its rejected lines with it
    pipeline.load_staging(spark, [str(path)], f"{tmp_path}/s")
    assert files.read_rejected(spark, f"{tmp_path}/s").count() == 0


def test_lines_parse_as_the_reader_parses_files(spark, tmp_path):
    path = tmp_path / "20240101.json"
    path.write_text('{"_source": {"Contract": 7, "TotalDuration": 1.5, "Date": "2024-01-02", "More": {"a": [1]}}}\n'
                    '{"_source": {"Contract": {"a":1}, "Mac": null}, "_id": 3}\n{"_source": {}}\n')
    by_line = landing.parse_lines(landing.read_lines(spark, [str(path)]))
    assert values(rows.flatten(by_line.select("_source"))) == values(rows.flatten(landing.read_file(spark, str(path))))


def test_broken_files_cost_a_job_each(spark, tmp_path):
    paths = [f"{tmp_path}/{n}.json" for n in range(6)]
    for n in (0, 1, 3, 5):
        Path(paths[n]).write_text("{}\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("probe", "probe")
    good, bad = landing.readable(spark, paths)
    jobs = len(tracker.getJobIdsForGroup("probe"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert good == [paths[n] for n in (0, 1, 3, 5)] and bad == [paths[2], paths[4]]
    assert jobs <= 2  # missing files are named before a job starts

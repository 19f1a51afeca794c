"""Headline timings: prints one JSON line. Median of three runs after one warm-up each."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from viewlog.plans import mart, pipeline  # noqa: E402
from viewlog.plans import warehouse as wh  # noqa: E402
from viewlog.registry.frames import Frames  # noqa: E402
from viewlog.registry.queries import all_queries  # noqa: E402
from viewlog.session import build_session, scratch_path  # noqa: E402

HEADLINES = (
    "contract_profile", "media_report", "fact_viewing_session", "mart_daily_summary",
    "contract_leaderboard", "kpi_7d", "daily_table", "type_statistics", "dq_unjoinable",
    "contract_profile_orders", "contract_leaderboard_orders",
)
RUNS = 3


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return time.perf_counter() - start


def median(job) -> float:
    job()
    return round(statistics.median(timed(job) for _ in range(RUNS)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    frames, queries = Frames(spark, sf_dir), all_queries()

    def noop(name: str):
        return lambda: queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def fresh_stores():
        return pipeline.stores(spark, scratch_path(spark, "bench"))

    loaded = fresh_stores()
    empty = [fresh_stores() for _ in range(RUNS + 1)]
    times = {name: median(noop(name)) for name in HEADLINES}
    times["load_warehouse"] = median(
        lambda stores=iter(empty): wh.load_warehouse(spark, frames.staging, next(stores)[0]))
    wh.load_warehouse(spark, frames.staging, loaded[0])
    times["load_mart"] = median(lambda stores=iter(empty): mart.load_mart(spark, loaded[0], next(stores)[1]))
    times["load_one_day"] = median(lambda: wh.load_warehouse(spark, frames.staging, loaded[0], "2024-01-16"))
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))
    spark.stop()


if __name__ == "__main__":
    main()

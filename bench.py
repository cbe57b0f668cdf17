"""Time the reports at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Every report is run to completion into Spark's ``noop`` sink, all of them in turn,
``$BENCH_RUNS`` times over. The figure per query is its best run (planning included), the
total is the sum of these. ``jobs`` are the load of the four exported files and the whole daily
run, once each, and are not part of the total.
"""

from __future__ import annotations

import json
import os
import time

from orderlens.driver_queries import REPORTS
from orderlens.driver_tables import export_csv, shop_tables
from orderlens.job import INPUTS, load_tables, run_job
from orderlens.session import local_session
from orderlens.workspace import clear_work, new_directory


def seconds(spark, report, sf_dir: str) -> float:
    started = time.perf_counter()
    report(shop_tables(spark, sf_dir)).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def job_seconds(spark, sf_dir: str) -> dict[str, float]:
    work = new_directory(spark, "bench")
    for name in INPUTS:
        export_csv(shop_tables(spark, sf_dir), work, name)
    started = time.perf_counter()
    load_tables(spark, work, f"{work}/tables")
    loaded = time.perf_counter()
    run_job(spark, work, f"{work}/out").collect()
    return {"load": round(loaded - started, 3), "daily_run": round(time.perf_counter() - loaded, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    rounds = [
        {name: seconds(spark, report, sf_dir) for name, report in REPORTS.items()}
        for _ in range(runs)
    ]
    jobs = job_seconds(spark, sf_dir)
    clear_work(spark)
    spark.stop()
    best = {name: round(min(times[name] for times in rounds), 3) for name in REPORTS}
    print(json.dumps({
        "metric": "total report time",
        "value": round(sum(best.values()), 3),
        "unit": "sec",
        "queries": best,
        "jobs": jobs,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()

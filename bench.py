"""Benchmark of the headline steps at one scale factor.

Mirrors the daily pipeline: every step reads what the previous step wrote,
as the production job does (stage table, production table). Prints ONE
JSON line. Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (8).

Steps (seconds, timed individually; ``value`` is their sum):
  normalize     two runs' export lines -> typed, keyed, hashed, validated
                -> stage table written (parquet, partitioned by ingestion date)
  csv_scan      Shift_JIS export files of all stores -> one scan, ragged-file
                check, header-name binding
  stage_dedup   run B's rows deduplicated per record_key
  merge_result  MERGE of run B into production after run A (full merged table)
  merge_apply   the partition-wise MERGE write into the production table
  daily_kpi     KPI view over the production table
  report        parameterised report (date range, ORDER BY, LIMIT 10000)
A JIT warm-up pass over the smallest fixture runs first and is not timed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bookflow.operators import reports as R  # noqa: E402
from bookflow.operators.mapping import map_columns  # noqa: E402
from bookflow.operators.stage import stage_dedup  # noqa: E402
from bookflow.plans import scenario as S  # noqa: E402
from bookflow.plans import tables as TB  # noqa: E402
from bookflow.session import build_session, scratch_path  # noqa: E402
from bookflow.sources import fixtures  # noqa: E402
from bookflow.sources.csv_files import scan_exports, write_exports  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
WARMUP_DIR = "/root/testdata/sf0.001"


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def timed(out, name, fn):
    t = time.perf_counter()
    r = fn()
    out[name] = round(time.perf_counter() - t, 3)
    return r


def run_all(spark, sf_dir, times, db):
    sc = timed(times, "normalize", lambda: S.build(spark, sf_dir))

    exports = scratch_path(spark, "bench-exports")
    write_exports(fixtures.reservations_export(spark, sf_dir), exports)
    timed(times, "csv_scan", lambda: noop(map_columns(scan_exports(spark, exports)[0], keep=("store_id",))))

    timed(times, "stage_dedup", lambda: noop(stage_dedup(sc.stage, fixtures.RUN_B["run_id"])))
    timed(times, "merge_result", lambda: noop(sc.merged()))

    root = tempfile.mkdtemp(prefix="bench-tables-") if spark.sparkContext.master.startswith("local") \
        else scratch_path(spark, "bench-tables")
    TB.create_tables(spark, db, root)
    TB.apply_merge(spark, db, sc.target)  # production after run A (setup, not timed)
    timed(times, "merge_apply", lambda: TB.apply_merge(spark, db, sc.source))

    prod = TB.read_production(spark, db)
    timed(times, "daily_kpi", lambda: noop(R.daily_kpi(prod)))
    timed(times, "report", lambda: R.report(prod, "1995-01-01", "2001-12-31").collect())


def main():
    spark = build_session(f"local[{CPUS}]", app="bookflow-bench", shuffle_partitions=max(8, CPUS * 2))
    warm: dict = {}
    t0 = time.perf_counter()
    run_all(spark, WARMUP_DIR, warm, "bench_warmup")
    warm_s = round(time.perf_counter() - t0, 3)
    times: dict = {}
    run_all(spark, SF_DIR, times, "bench_main")
    sf = SF_DIR.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "pipeline_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": CPUS,
        "warmup_sec": warm_s,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

"""Benchmark: the gated retail run and its parts at one scale factor.

Setup (untimed): the flat invoice feed and the three raw tables are derived
from the star-schema tables in ``$BENCH_SF_DIR`` and written as CSV, the raw
format of the baseline pipeline; warm-up runs at the same scale prime the JVM
(JIT, generated-code cache; the gated run twice).  Timed figures are the
median of ``$BENCH_REPEAT`` (default 3) runs.

Timed:
  prepare       feed CSV -> customers, orders, order_items (+ drop reasons)
  gated_run     raw CSV -> typed load -> 25 checks + report rows -> fact ->
                4 marts -> release pointer -> run summary (the headline,
                comparable to the baseline's whole-run time)
  quality_gate  the 25 checks alone over the raw CSV tables
  marts_<name>  one mart straight from the raw tables (collect)

Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import uuid
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerlark.operators import marts, quality  # noqa: E402
from ledgerlark.plans import job, prepare  # noqa: E402
from ledgerlark.session import build_session, shared_dir  # noqa: E402
from ledgerlark.sources import files, sinks  # noqa: E402
from ledgerlark.sources.driver_tables import DriverTables  # noqa: E402


def _materialise(spark, sf_dir: str, root: str) -> tuple[str, str, int]:
    tables = DriverTables(spark, sf_dir)
    feed = f"{root}/feed"
    sinks.write_csv(tables.retail_source(), feed)
    raw = f"{root}/raw"
    for name, frame in tables.raw_tables().items():
        sinks.write_csv(frame, f"{raw}/{files.RAW_FILES[name]}")
    loaded = files.load_raw_tables(spark, raw, fmt="csv")
    rows = sum(f.count() for f in loaded.frames.values())
    return feed, raw, rows


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return time.perf_counter() - t0, out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", shuffle_partitions=int(cpus),
        extra_conf={"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
                    "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    root = f"{shared_dir(spark)}/ledgerlark-bench/{uuid.uuid4().hex}"

    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    feed, raw, raw_rows = _materialise(spark, sf_dir, f"{root}/data")

    # Warm-up at the bench scale (untimed): the JIT keeps improving over the
    # first runs of each plan shape, so the gated run is warmed twice.
    prepare.prepare_source(spark, feed, f"{root}/warm/prep", home_country="NATION_0")
    for w in range(2):
        job.run_pipeline(spark, raw, f"{root}/warm/wh{w}", f"{root}/warm/reports{w}",
                         raw_format="csv")

    samples: dict[str, list[float]] = {"prepare": [], "gated_run": []}
    for i in range(repeat):
        sec, _ = _timed(lambda: prepare.prepare_source(
            spark, feed, f"{root}/prep{i}", home_country="NATION_0"))
        samples["prepare"].append(sec)
        sec, summary = _timed(lambda: job.run_pipeline(
            spark, raw, f"{root}/wh{i}", f"{root}/reports{i}", raw_format="csv"))
        assert summary["status"] == "success", summary
        samples["gated_run"].append(sec)
    times: dict[str, float] = {k: statistics.median(v) for k, v in samples.items()}

    def gate():
        loaded = files.load_raw_tables(spark, raw, fmt="csv")
        return quality.QualityEngine(loaded.frames).run()

    gate()  # untimed: the first run of this plan shape
    samples["quality_gate"] = []
    for _ in range(repeat):
        sec, checks = _timed(gate)
        assert all(c.passed for c in checks)
        samples["quality_gate"].append(sec)
    times["quality_gate"] = statistics.median(samples["quality_gate"])

    loaded = files.load_raw_tables(spark, raw, fmt="csv").frames
    fact = marts.fact_order_items(loaded["customers"], loaded["orders"], loaded["order_items"])
    for name, frame in marts.build_marts(fact).items():
        times[f"marts_{name}"], _ = _timed(frame.collect)

    print(json.dumps({
        "metric": "gated_run_seconds",
        "value": round(times["gated_run"], 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": Path(sf_dir).name.removeprefix("sf"),
        "raw_rows": raw_rows,
        "raw_rows_per_sec": round(raw_rows / times["gated_run"], 1),
        "runs": {k: [round(x, 3) for x in v] for k, v in samples.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()

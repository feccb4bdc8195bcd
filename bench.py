"""Benchmark the headline operators at one scale factor.

Runs each headline query (and the naive plan shape it replaces) on
``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with ``local[$BENCH_CPUS]``;
every run executes the whole plan into Spark's ``noop`` sink (nothing is
collected).  Prints one JSON line: ``value`` is the sum of the headline
medians; ``naive`` holds the naive shapes' medians for comparison (runs of an
operator and its naive shape are interleaved).  ``merges`` times the one job
step that writes a table: an increment of a hundredth of the stored ledger,
merged into the folders it touches, against the rewrite of the whole table
(these are not part of ``value``).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from ledgerflow import config as C  # noqa: E402
from ledgerflow.plans import catalog as Q, naive  # noqa: E402
from ledgerflow.session import local_session  # noqa: E402
from ledgerflow.sources import partitioned, tables  # noqa: E402
from ledgerflow.sources.fixtures import FX_CDC, FX_MAP, Fixtures  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(build) -> float:
    t0 = time.perf_counter()
    sink(build())
    return time.perf_counter() - t0


def median_times(*builds) -> list[float]:
    """Median wall time of each plan; the plans' runs are interleaved so that
    an operator and its naive shape see the same machine conditions."""
    for build in builds:
        sink(build())  # warm-up (JIT, file listing, broadcast of the map)
    times: list[list[float]] = [[] for _ in builds]
    for _ in range(RUNS):
        for i, build in enumerate(builds):
            times[i].append(timed(build))
    return [round(statistics.median(t), 3) for t in times]


def merge_times(spark, ledger) -> dict[str, float]:
    """Median seconds of a merge of the newest hundredth of ``ledger``."""
    ledger = tables.materialise(ledger)
    base, layout = tempfile.mkdtemp(prefix="ledgerflow-bench-"), partitioned.dated(C.INSERT_DATE, "month")
    cut = ledger.select(F.col(C.INSERT_DATE).cast("timestamp").cast("double").alias("s")).approxQuantile("s", [0.99], 0.001)[0]
    newest = tables.materialise(ledger.where(F.col(C.INSERT_DATE).cast("timestamp").cast("double") >= cut))
    partitioned.upsert_partitions(spark, f"{base}/touched", ledger, C.LEDGER_KEY, layout)
    tables.write_snapshot(ledger, f"{base}/whole")
    shapes = {"touched_folders": lambda: partitioned.upsert_partitions(spark, f"{base}/touched", newest, C.LEDGER_KEY, layout),
              "whole_rewrite": lambda: tables.upsert_table(spark, f"{base}/whole", newest, C.LEDGER_KEY)}
    times: dict[str, list[float]] = {name: [] for name in shapes}
    for _ in range(RUNS + 1):
        for name, run in shapes.items():
            t0 = time.perf_counter()
            run()
            times[name].append(time.perf_counter() - t0)
    for frame in (ledger, newest):
        tables.discard(frame)
    return {name: round(statistics.median(t[1:]), 3) for name, t in times.items()}   # the first run warms up


def main() -> None:
    spark = local_session(cores=CPUS)
    fx = Fixtures.of(spark, SF_DIR)

    def conformed():
        from ledgerflow.operators.conform import conform_transactions
        from ledgerflow.sources.fixtures import FX_CONCEPTS, FX_OPERATIONS
        return conform_transactions(fx.operations, FX_OPERATIONS, F.col("country")).unionByName(
            conform_transactions(fx.concepts, FX_CONCEPTS, F.col("country")))

    def naive_tx():
        from ledgerflow.functions.dates import with_date_parts
        return with_date_parts(naive.sign_split(conformed()), C.INSERT_DATE)

    headline = {
        "post_ledger": lambda: Q.post_ledger(spark, SF_DIR),
        "unmapped_entries": lambda: Q.unmapped_entries(spark, SF_DIR),
        "latest_by_key": lambda: Q.latest_by_key(spark, SF_DIR),
        "upsert_by_key": lambda: Q.upsert_by_key(spark, SF_DIR),
        "incremental_since": lambda: Q.incremental_since(spark, SF_DIR),
        "apply_changes": lambda: Q.apply_changes(spark, SF_DIR),
        "reprocess_candidates": lambda: Q.reprocess_candidates(spark, SF_DIR),
    }
    naive_shapes = {
        "post_ledger": lambda: naive.post_ledger(naive_tx(), Q._map(fx), FX_MAP),
        "unmapped_entries": lambda: naive.unmapped(naive_tx(), Q._map(fx), FX_MAP),
        "latest_by_key": lambda: naive.latest_by_key(fx.cdc, FX_CDC.keys, FX_CDC.sequence),
        "incremental_since": lambda: naive.newer_than(Q._ledger(fx), Q._gold_ledger(fx), C.INSERT_DATE),
    }
    results, naive_results = {}, {}
    for name, fn in headline.items():
        if name in naive_shapes:
            results[name], naive_results[name] = median_times(fn, naive_shapes[name])
        else:
            results[name], = median_times(fn)
    merges = merge_times(spark, Q.post_ledger(spark, SF_DIR))
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_operators_total_median",
        "value": round(sum(results.values()), 3),
        "unit": "sec",
        "queries": results,
        "naive": naive_results,
        "merges": merges,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": CPUS,
        "runs": RUNS,
    }))
    spark.stop()


if __name__ == "__main__":
    main()

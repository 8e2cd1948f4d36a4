"""Headline benchmark: prints ONE JSON line.

grid — resample_last, ohlc, rolling_data (7 metrics x 4 columns),
portfolio (60 ordered triples), scan_features pivot, plus the grid-heavy
builders. Each query runs to completion through the ``noop`` sink (no
collect); the value per query is the median of 3 warm runs.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_1S=0 (leave out the one-second grid, which runs once).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
ONE_SECOND = os.environ.get("BENCH_1S", "1") == "1"

FREQ = 60                    # grid step (s)
WINDOW = 3600                # rolling window (s) = 60 grid rows
SHIFT = 10                   # label look-ahead (rows)
MIN_PERIODS = 10
RET_WINDOW = 60              # return lag (rows)


def main() -> None:
    from pyspark.sql import functions as F

    from tidemark.operators import grid as G
    from tidemark.operators import patterns as T_
    from tidemark.operators import portfolio as PF
    from tidemark.plans import datasets as B
    from tidemark.schema import QUOTE_COLUMNS
    from tidemark.session import local_session
    from tidemark.sinks.writers import features_long, write_features
    from tidemark.sources.adapters import quotes
    from tidemark.sources.scans import scan_features

    spark = local_session(CPUS, shuffle_partitions=max(8, CPUS))
    q = quotes(spark, SF_DIR)
    inst = sorted(f"SIM_{r[0]}" for r in spark.read.parquet(f"{SF_DIR}/events.parquet")
                  .select("event_type").distinct().collect())
    feats = [f"{c}.{m}" for c in QUOTE_COLUMNS for m in
             ("rolling_mean", "rolling_var", "rolling_coeff", "rolling_min", "rolling_max", "rolling_open",
              "rolling_close")]

    # setup (not timed): a landed long-feature table for the pivot scan
    froot = tempfile.mkdtemp(prefix="tidemark-bench-", dir="/tmp") + "/features"
    grid4 = G.resample_last(q, FREQ, QUOTE_COLUMNS)
    write_features(features_long(grid4, list(QUOTE_COLUMNS)), froot)

    def merged():
        r = PF.fee_returns(G.resample_last(q, FREQ, ("bid_price", "ask_price")), RET_WINDOW, FREQ)
        return PF.merge_returns(r, inst)

    queries = {
        "resample_last": lambda: G.resample_last(q, FREQ, QUOTE_COLUMNS),
        "ohlc": lambda: B.ohlc(q, WINDOW, SHIFT, 0.001, freq=FREQ),
        "rolling_data": lambda: B.rolling_data(q, feats, WINDOW, True, SHIFT, MIN_PERIODS, freq=FREQ),
        "portfolio": lambda: PF.portfolio_report(merged(), inst),
        "scan_features": lambda: scan_features(spark, froot, list(QUOTE_COLUMNS)),
        "moving_average_shift": lambda: B.moving_average_shift(q, WINDOW, SHIFT, freq=FREQ),
        "pattern_mean": lambda: T_.pattern_table(q, "mean", WINDOW, SHIFT, 5, 8, 0.0, freq=FREQ),
        "resample_asof_next": lambda: G.resample_asof_next(q, FREQ, QUOTE_COLUMNS),
    }
    # the reference's own grid step: a row a second (13M rows at sf0.1), run once each
    once = {
        "grid_1s": lambda: G.resample_last(q, 1, QUOTE_COLUMNS),
        "ohlc_1s": lambda: B.ohlc(q, 3600, 600, 0.001, freq=1),
        "rolling_all_fields_1s": lambda: B.rolling_all_fields(q, 3600, 600, 0.001, MIN_PERIODS, freq=1),
    }

    def run(build) -> float:
        t = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name, build in queries.items():
        run(build)  # warm-up (JIT, file listing cache)
        times[name] = round(statistics.median(run(build) for _ in range(RUNS)), 3)
        rows[name] = build().count()
    total = round(sum(times.values()), 3)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    seconds = {name: round(run(build), 3) for name, build in once.items()} if ONE_SECOND else {}
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": total,
        "unit": "sec",
        "queries": times,
        "queries_1s_grid": seconds,
        "rows": rows,
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "grid_seconds": FREQ,
        "cpus": CPUS,
    }))
    del F


if __name__ == "__main__":
    main()

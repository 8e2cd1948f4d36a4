"""Plan guard: single-partition exchanges only where the data is provably tiny."""

import __spark_entry__ as E
from tidemark.registry import QUERIES as MAIN
from tidemark.registry_tables import QUERIES as TABLES

QUERIES = MAIN | TABLES

SF = "/root/testdata/sf0.001"
STREAMING = {"stream_buffer", "stream_signal", "stream_predict", "replay", "stream_dedupe", "stream_candles",
             "stream_predict_logistic", "stream_predict_scaled"}

# Each entry: why its single-partition step is bounded, whatever the data volume.
ALLOWED = {
    "missing_partitions": "scalar subquery over distinct days (calendar-bounded)",
    "null_profile": "one-row global aggregate",
    "label_encode": "window over the classes' ranges (a row a partition)",
    "classification_report": "windows over the per-class table (k rows)",
    "imbalanced_report": "windows over the per-class table (k rows)",
    "shuffled_split": "window over per-bucket counts (one row for a million rows, 256 at least)",
    "train_logistic": "window over per-bucket counts (one row for a million rows, 256 at least)",
    "minmax_scale": "one-row scaler as a scalar subquery",
    "chi2_kbest": "window over the per-class table (k rows)",
    "params_matrix": "one-row aggregate of distinct parameter values",
    "knn_predict": "one-row scaler; window over per-bucket counts of the split",
    "align_asof_next": "window over per-chunk summaries of the one aligned series (calendar-bounded)",
    "missing_days": "scalar subquery over distinct days (calendar-bounded)",
    "dropped_rows": "one-row global aggregate",
    "select_columns": "one-row scaler; window over the per-class table (k rows)",
    "top_features": "one-row scaler; window over the per-class table (k rows)",
}


def test_single_partition_only_where_bounded(spark):
    offenders = []
    for name, fn in E.queries().items():
        if name in STREAMING or name not in QUERIES:  # tests/llm sees to its own
            continue
        df = fn(spark, SF)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        if "SinglePartition" in plan and name not in ALLOWED:
            offenders.append(name)
    assert offenders == []

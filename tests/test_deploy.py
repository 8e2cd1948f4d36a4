"""Executors need no installed copy of the package (code travels by value)."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


#: One query of every kind of worker function: frames, buffers, state, cogroups, Arrow maps, pandas functions.
NAMES = ("rolling_data", "pattern_mean", "tick_buffer", "stream_signal", "stream_buffer", "stream_predict_scaled", "portfolio",
         "ar1_forecast", "knn_predict", "boruta")


def test_pandas_and_stream_queries_from_foreign_cwd(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
                 .config("spark.ui.showConsoleProgress", "false").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        import __spark_entry__ as E
        for n in {NAMES!r}:
            print(n, E.queries()[n](spark, "/root/testdata/sf0.001").count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env, capture_output=True,
                         text=True, timeout=1200)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [ln for ln in out.stdout.splitlines() if ln.split(" ")[0] in NAMES]
    assert len(lines) == len(NAMES) and all(int(ln.split()[1]) > 0 for ln in lines)

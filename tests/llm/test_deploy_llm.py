"""Executors need no installed copy: queries with Python workers, from a foreign working directory."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
NAMES = ("op1_html", "op7_pq", "op9_tokenfiles", "op11_threshold", "op12_repair", "op13_warc")


def test_queries_from_foreign_cwd(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {REPO!r})
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "4").getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        import __spark_entry__ as E
        for n in {NAMES!r}:
            print("ran", n, E.queries()[n](spark, "/root/testdata/sf0.001").count())
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env["PYTHONPATH"] = ":".join(p for p in os.environ.get("PYTHONPATH", "").split(":") if p and not p.startswith(REPO))
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env, capture_output=True, text=True, timeout=1200)
    assert out.returncode == 0, out.stderr[-2000:]
    assert sorted(x.split()[1] for x in out.stdout.splitlines() if x.startswith("ran ")) == sorted(NAMES)

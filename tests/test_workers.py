"""Python workers must not need this package importable (a cluster's executors
may not have it installed): functions shipped to them are pickled by value."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent(f"""
    import sys
    sys.path.insert(0, {ROOT!r})
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    from eventloom.operators.dedupe import dedupe_fifo, dedupe_within_horizon
    from pyspark.sql import functions as F
    rows = [("s", "e", str(v), i) for i, v in enumerate([7, 8, 7, 9, 5, 7, 8])]
    df = spark.createDataFrame(rows, "source string, source_event_endpoint string, source_event_id string, seq long")
    a = sorted(r.seq for r in dedupe_fifo(df, max_size=3, chunk_rows=3).collect())
    timed = df.withColumn("observed_ts", F.timestamp_seconds("seq"))
    b = sorted(r.seq for r in dedupe_within_horizon(timed, "4 seconds").collect())
    print("RESULT", a, b)
""")


def test_pandas_functions_run_without_the_package_on_workers(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("RESULT")]
    assert line == ["RESULT [0, 1, 3, 4, 5, 6] [0, 1, 3, 4, 5, 6]"], out.stderr[-2000:]

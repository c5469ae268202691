"""A task that dies on its first attempt (a lost executor, as far as the job
can tell) is retried: the landed batch has every row exactly once and the
observed count is not inflated by the failed attempt."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = textwrap.dedent("""
    import sys, tempfile
    sys.path.insert(0, %(root)r)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F, types as T
    from tidewater.plans.prepare import prepare
    from tidewater.sinks import write_lake
    from tidewater.sources import read_lake

    spark = (SparkSession.builder.master("local[4,3]")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("WARN")

    @F.udf(T.LongType())
    def die_once(v):  # test-only fault injection
        ctx = TaskContext.get()
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0 and v == 3000:
            raise RuntimeError("simulated executor loss")
        return v

    src = spark.range(0, 10000, numPartitions=4).select(die_once("id").alias("ID"))
    out = tempfile.mkdtemp()
    n = write_lake(prepare(src, "K", "1", "me", "SRC"), out, "incremental")
    back = read_lake(spark, out)
    print("RESULT", n, back.count(), back.select("ID").distinct().count())
""")


def test_retried_task_lands_each_row_once():
    proc = subprocess.run([sys.executable, "-c", SCRIPT % {"root": ROOT}],
                          capture_output=True, text=True, timeout=300)
    line = [ln for ln in proc.stdout.splitlines() if ln.startswith("RESULT")]
    assert line, proc.stderr[-3000:]
    assert line[0].split()[1:] == ["10000", "10000", "10000"]
    assert "simulated executor loss" in proc.stderr

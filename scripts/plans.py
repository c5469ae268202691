"""Print the formatted physical plans of the headline operators.

    python scripts/plans.py [sf_dir]

Nothing is written: change detection and de-duplication run over hashed
frames derived in memory from lineitem.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidewater.constants import BATCH_ID  # noqa: E402
from tidewater.operators import (  # noqa: E402
    add_row_hash, dedupe_by_hash, dedupe_new_rows, detect_changes,
)
from tidewater.plans.prepare import prepare  # noqa: E402
from tidewater.plans.session import session_conf  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    b = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false")
    for k, v in session_conf(shuffle_partitions=8).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    prepared = prepare(li, "K", "1", "INGEST_JOB", "SRC")
    hashed = add_row_hash(li, "H").drop("ETL_ROW_HASH")
    later = add_row_hash(li.where(F.col("l_returnflag") != "R"), "H").drop("ETL_ROW_HASH")
    batched = hashed.withColumn(BATCH_ID, F.lit("1"))
    shown = {
        "prepare (O1)": prepared,
        "prepare + projection + filter": prepared.select("L_ORDERKEY", "K")
                                                 .where(F.col("L_ORDERKEY") < 100),
        "emptiness probe of load_gate (V1, taken incrementally)": prepared.select().limit(1),
        "dedupe_by_hash (X1)": dedupe_by_hash(batched, "H"),
        "dedupe_new_rows (X1, incremental)": dedupe_new_rows(dedupe_by_hash(batched, "H"),
                                                             batched, "H"),
        "detect_changes (X2)": detect_changes(hashed, later, "H", ["l_orderkey", "l_linenumber"]),
    }
    for title, df in shown.items():
        print("=" * 78)
        print(title)
        print("=" * 78)
        df.explain("formatted")


if __name__ == "__main__":
    main()

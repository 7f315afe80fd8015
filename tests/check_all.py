"""Compare and time every named query: python tests/check_all.py FOLDER [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from compare import difference  # noqa: E402


def main(base, names):
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        began = time.time()
        try:
            df = query(spark, base)
            verdict = difference(df, sql[name], base) if name in sql else f"rows {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:28s} {time.time() - began:6.2f}s  {verdict or 'same'}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])

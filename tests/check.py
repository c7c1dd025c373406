"""Run all or some queries against their oracles: ``python tests/check.py [names]``."""

import os
import sys
import time

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402


def main() -> int:
    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    con = connect(folder)
    runs, sql = entry.queries(), entry.oracle_sql()
    wanted = sys.argv[1:] or list(runs)
    if wanted[0].startswith("@"):
        from heronlake.catalog.registry import QUERIES

        wanted = [n for n, q in QUERIES.items() if q.run.__module__.endswith("." + wanted[0][1:])]
    bad = 0
    for name in wanted:
        start = time.time()
        try:
            df = runs[name](spark, folder)
            if name in sql:
                error = compare(df, con, sql[name])
                note = "" if error is None else error
            else:
                note, error = f"no oracle, {df.count()} rows", None
        except Exception as problem:  # noqa: BLE001
            error = note = f"{type(problem).__name__}: {str(problem)[:600]}"
        bad += error is not None
        print(f"{'ok ' if error is None else 'BAD'} {time.time() - start:6.2f}s {name} {note}", flush=True)
    print(f"{len(wanted)} run, {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(bool(main()))

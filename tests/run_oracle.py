"""python tests/run_oracle.py [sf_dir] [name...]: compare queries with their SQL, with seconds."""

import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from oracle import compare, connect  # noqa: E402

from bindings import ORACLES, QUERIES  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for n in names:
        start = time.time()
        try:
            problem = compare(QUERIES[n](spark, sf), con, ORACLES[n]) if n in ORACLES else "no SQL"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {n} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} equal")

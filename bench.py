"""Time the queries of the catalog; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
All queries of the catalog run; BENCH_QUERIES may name a comma-separated selection.
"""

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from paperfield.catalog import QUERIES
from paperfield.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else list(QUERIES)
    settings = {"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"}
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        settings["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="paperfield-bench-")
    spark = build_session("paperfield-bench", f"local[{cpus}]", **settings)
    spark.sparkContext.setLogLevel("OFF")
    QUERIES["url_domain"](spark, folder).write.format("noop").mode("overwrite").save()  # start the session
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = float(os.path.basename(folder.rstrip("/")).removeprefix("sf"))
    print(json.dumps({"metric": "catalog_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": scale}))


if __name__ == "__main__":
    main()

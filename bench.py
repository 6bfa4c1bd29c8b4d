"""Times every registered query and prints one JSON line.

BENCH_SF_DIR picks the tables, BENCH_CPUS the cores, BENCH_QUERIES (names with
commas) a part of the queries.  Each query runs once to warm up and is then timed;
its rows go to a sink that discards them.
"""

from __future__ import annotations

import json
import os
import sys
import time

from energylake.queries import REGISTRY
from energylake.session import build_session


def run(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(REGISTRY)
    spark = build_session("bench", {
        "spark.master": f"local[{cpus}]", "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, name, sf_dir)
        seconds[name] = round(run(spark, name, sf_dir), 4)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds,
                      "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()

"""Wall seconds of the headline jobs, every row computed; prints one JSON line.

The jobs run over the twelve tables as stored Parquet, the way the command line runs them; the
operators run over the given tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fixtures import star as fx  # noqa: E402
from fixtures.queries import JOBS, QUERIES, scratch  # noqa: E402
from patronage.plans.ingest import ingest  # noqa: E402
from patronage.plans.star import star_from_parquet  # noqa: E402
from patronage.session import local_session  # noqa: E402

HEADLINE = (
    "customer_360",
    "customer_360_clean",
    "customer_analytics",
    "customer_analytics_per_channel",
    "feature_table",
    "feature_step",
    "returns_fanout",
    "sales_union",
    "distinct_days",
    "store_agg",
    "dim_profile",
    "label_encode",
    "ingest_manifest",
)
RUNS = 3


def seconds(spark, name: str, sf_dir: str, base: str) -> float:
    start = time.perf_counter()
    result = JOBS[name](star_from_parquet(spark, base)) if name in JOBS else QUERIES[name](spark, sf_dir)
    result.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    base, tables = scratch(spark), fx.tables(spark, sf_dir)
    ingest(spark, tables.__getitem__, list(tables), base)  # also start-up and class loading
    times = {
        name: round(min(seconds(spark, name, sf_dir, base) for _ in range(RUNS)), 3) for name in HEADLINE
    }
    result = {
        "metric": f"sum of best of {RUNS} runs per query",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cores": cores,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()

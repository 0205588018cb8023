"""Headline timings: one JSON line.

Every query is timed from the raw Parquet tables to a full materialisation of its result. The untimed first
call of each query only warms the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from mostrador.checks.registry import QUERIES  # noqa: E402
from mostrador.session import build_session  # noqa: E402

HEADLINE = (
    "sales_dedup", "fact_sales", "daily_report", "product_ranking", "sales_by_rain", "upsert_sales", "upsert_fact",
    "dq_report", "asof_fx", "scan_sales_csv",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]", "bench", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"), "lineitem_rows": lines,
        "rows_per_sec": {name: round(lines / taken) for name, taken in seconds.items()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()

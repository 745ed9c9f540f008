"""Benchmark the headline queries.

Runs each selected query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
on ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

Each query is fully executed (written to a no-op sink) so the whole plan runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pricelens.plans import catalog  # noqa: E402
from pricelens.session import get_spark  # noqa: E402

HEADLINE = [
    "dq_ingest_rules", "dq_prefact_rules", "facts_gated", "scd2_rebuild", "current_prices",
    "anom_statistical", "anom_temporal", "anom_cross_partner", "anom_variance", "baselines",
    "daily_prices", "name_topk", "batch_summary", "pipeline_summary",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2,
                      driver_memory=os.environ.get("BENCH_DRIVER_MEMORY", "6g"))
    names = [n for n in HEADLINE if n in catalog.QUERIES]
    wanted = os.environ.get("BENCH_QUERIES")
    if wanted:
        names = [n for n in wanted.split(",") if n in catalog.QUERIES]
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        df = catalog.QUERIES[name](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()

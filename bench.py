"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose
input and cores. Each query runs twice over the whole table, the faster run counts, after
one query to warm up.
"""

from __future__ import annotations

import json
import os
import time

from checks.queries import registry
from tickloom.session import local_session

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
ALSO = (
    "L1_load_dataset",
    "L9_list_symbols",
    "L12_month_gaps",
    "L13_panel",
    "L14_write_lake",
    "L14_write_in_parts",
    "L14_write_datasets_tally",
    "L14_write_datasets_path",
    "L14_write_datasets_quotes",
    "L14_write_datasets_book",
    "L14_write_datasets_deriv",
    "X2_asof_join",
    "X3_resample_ohlcv",
    "X4_stream_ohlcv",
)


def main() -> None:
    spark = local_session(CPUS, "bench")
    queries = registry()
    names = [name for name in queries if name.startswith("B")] + list(ALSO)
    queries["B1_ohlcv"](spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, FOLDER).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

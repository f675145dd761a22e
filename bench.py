"""Times every query at one scale and prints one JSON line.

BENCH_SF_DIR  folder of the test tables   (default /root/testdata/sf0.1)
BENCH_CPUS    threads of the local master (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewell.queries import all_queries  # noqa: E402
from tidewell.session import build_session  # noqa: E402


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = set(sys.argv[1:])
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {n: q for n, q in all_queries().items() if not only or n in only}

    # Start-up and first-use compilation are not what is measured.
    queries_to_warm = [n for n in ("gold_monthly_region", "clean_sales") if n in queries]
    for name in queries_to_warm:
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name, build in queries.items():
        start = time.perf_counter()
        build(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("/sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()

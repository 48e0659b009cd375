"""Time the catalogue's queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ridelake.catalog.queries import queries  # noqa: E402
from ridelake.session import build_session, release_staging  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = sys.argv[1:]
    spark = build_session(
        "ridelake-bench",
        f"local[{cpus}]",
        spark__ui__enabled="false",
        spark__driver__memory="12g",
        spark__sql__shuffle__partitions=cpus,
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = queries()
    # Start-up and class loading are not part of any query.
    registry["demand_daily"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name, run in registry.items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    release_staging(spark)
    print(
        json.dumps(
            {
                "metric": "catalogue_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

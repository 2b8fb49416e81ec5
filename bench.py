"""Headline queries, timed. Prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from shelfcast import catalog  # noqa: E402
from shelfcast.session import build  # noqa: E402

HEADLINE = (
    "star_sales",
    "aggregate_sales",
    "densify_observed",
    "densify_monthly",
    "series_frame",
    "series_frame_by_day",
    "future_frame",
    "calendar_rules_consoles",
    "time_series_folds",
    "score",
    "profile",
    "attach_last_attributes",
    "keep_eligible",
    "normal_stats",
    "design_matrix",
    "forecast",
    "grid_search",
    "random_search",
    "tweedie_forecast",
    "console_line_frame",
    "device_line_forecast",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.checkpoint.dir": f"{Path.cwd().as_uri()}/spark-warehouse/bench",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    # Start the JVM's and the workers' engines before the clock does.
    catalog.sales_from_star(spark, sf_dir).write.format("noop").mode("overwrite").save()
    spent, failed = {}, {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        try:
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as error:  # the other queries are timed all the same
            failed[name] = f"{type(error).__name__}: {error}"[:300]
            print(f"{name}: {failed[name]}", file=sys.stderr, flush=True)
            continue
        spent[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {spent[name]}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(spent.values()), 3),
                "unit": "sec",
                "queries": spent,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                **({"failed": failed} if failed else {}),
            }
        )
    )
    spark.stop()
    sys.exit(bool(failed))


if __name__ == "__main__":
    main()

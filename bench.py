"""Time the headline queries and print one JSON line.

The test tables are mapped to raw inputs (``map:<input>``) and the tables the views read are
derived from them (``build:<table>``); a view is then timed over the written tables, as a
report would read them. ``run:`` times whole runs from CSV files. ``BENCH_REPEAT`` times each query that often and reports the fastest.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mercata.plans import generator, jobs  # noqa: E402
from mercata.plans.queries import BUILDERS, comparable  # noqa: E402
from mercata.plans.workspace import Workspace  # noqa: E402
from mercata.session import build_session, clear_scratch  # noqa: E402
from mercata.sources.warehouse import Warehouse  # noqa: E402

BUILT = (
    "raw_orders", "raw_order_items", "raw_order_payments", "raw_order_reviews", "raw_products", "raw_customers",
    "raw_sellers", "raw_category_translation", "stg_orders", "stg_order_items", "stg_order_payments",
    "stg_order_reviews", "stg_products", "stg_customers", "stg_sellers", "stg_category_translation",
    "rejected_rows", "load_audit", "dim_product", "dim_seller", "dim_customer", "fct_order_items", "fct_orders",
)
READ_ONLY = ("generated_", "stage_", "rejected_rows", "load_audit", "dim_", "fct_", "run_")
# These rest on a seed and several days, which are timed as ``run:`` above.
AFTER_RUNS = ("rerun_audit", "audit_export", "registered_view", "rollback_batch", "stream_batches")


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not part of any query

    times: dict[str, float] = {}

    def timed(name: str, work) -> None:
        start = time.perf_counter()
        work()
        spent = round(time.perf_counter() - start, 3)
        times[name] = min(spent, times.get(name, spent))

    workspace = Workspace.of(spark, folder)
    for table in workspace.source:
        timed(f"map:{table}", lambda: workspace.source[table])
    for table in BUILT:
        timed(f"build:{table}", lambda: workspace[table])
    # One whole run each, from CSV files to an audited mart.
    root = f"{workspace.root}/bench"
    first_day = workspace.plan.first_day
    warehouse = Warehouse(spark, f"{root}/warehouse")
    warehouse.create()
    timed("write:seed", lambda: generator.write_seed(workspace.source, f"{root}/seed", workspace.plan))
    timed("run:seed", lambda: jobs.run_seed(warehouse, f"{root}/seed"))
    timed("write:day", lambda: generator.write_day(workspace.source, root, first_day, workspace.plan))
    timed("run:next_batch", lambda: jobs.run_next_batch(warehouse, root))
    timed("run:rebuild_mart", lambda: jobs.rebuild_mart(warehouse))
    for name, build in BUILDERS.items():
        if name.startswith(READ_ONLY) or name in AFTER_RUNS:
            continue  # timed as a build or a run
        for _ in range(repeat):
            # Every column of every row is computed; nothing is sent to the driver.
            timed(name, lambda: comparable(build(workspace)).write.format("noop").mode("overwrite").save())

    clear_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "total time of table builds and queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

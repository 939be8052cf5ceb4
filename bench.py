"""Times the headline queries and the Bronze, Silver and Gold jobs; prints one JSON line.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
Queries run end to end from the tables into a sink that drops the rows; the
jobs write Parquet and CSV under the shared folder.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import jobs  # noqa: E402
from registry.queries import ALL_QUERIES  # noqa: E402
from tallyrock.operators import facts  # noqa: E402
from tallyrock.operators.dims import dim_date  # noqa: E402
from tallyrock.plans.gold import refresh_gold  # noqa: E402
from tallyrock.plans.gold_increment import refresh_gold_increment  # noqa: E402
from tallyrock.plans.silver import silver_mark  # noqa: E402
from tallyrock.schema import BATCH_COLUMN, SILVER_TABLE_DDL  # noqa: E402
from tallyrock.sinks.tables import replace_batches, write_mark  # noqa: E402
from tallyrock.sources.tables import read_table  # noqa: E402
from tallyrock.session import configure, scratch_path  # noqa: E402

HEADLINE = (
    "parse_json_payload",
    "quality_report",
    "latest_per_transaction",
    "silver",
    "lifecycle_fact",
    "fraud_fact",
    "credit_risk_fact",
    "daily_summary",
    "dim_date",
    "dim_account",
    "kpi_settlement",
    "kpi_risk_trend",
    "bronze_stream",
    "silver_stream",
)

ON_SILVER = {
    "lifecycle_fact": facts.lifecycle_fact,
    "fraud_fact": facts.fraud_fact,
    "credit_risk_fact": facts.credit_risk_fact,
    "daily_summary": facts.daily_summary,
    "dim_date": dim_date,
}
HISTORY = 120


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, work):
        started = time.monotonic()
        result = work()
        seconds[name] = round(time.monotonic() - started, 3)
        return result

    def drain(name):
        ALL_QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()

    for name in ("row_count", "silver"):  # warms up the JVM, not counted
        drain(name)
    for name in HEADLINE:
        timed(name, lambda: drain(name))

    silver, gold = scratch_path(spark, "silver"), scratch_path(spark, "gold")
    bronze = timed("bronze_load", lambda: jobs.bronze_table(spark, folder))
    timed("silver_run", lambda: jobs.silver_run(spark, bronze, silver))
    timed("silver_run_nothing_new", lambda: jobs.silver_run(spark, bronze, silver))
    for name, fact in ON_SILVER.items():
        rows = read_table(spark, silver, schema=SILVER_TABLE_DDL)
        timed(f"{name}_on_silver", lambda: fact(rows).write.format("noop").mode("overwrite").save())

    # A history of many runs: what a run costs must not follow it.
    old = scratch_path(spark, "silver")
    rows = read_table(spark, silver, schema=SILVER_TABLE_DDL)
    batch = F.concat(F.lit("from-"), F.pmod(F.xxhash64("transaction_id"), F.lit(HISTORY)).cast("string"))
    replace_batches(rows.withColumn(BATCH_COLUMN, batch).repartition(BATCH_COLUMN), old)
    write_mark(spark, old, mark=silver_mark(spark, silver))
    kept = scratch_path(spark, "gold")
    timed(f"silver_run_after_{HISTORY}_batches", lambda: jobs.silver_run(spark, bronze, old))
    timed(f"gold_totals_first_of_{HISTORY}_batches", lambda: refresh_gold_increment(spark, old, kept))
    timed(f"gold_totals_after_{HISTORY}_batches", lambda: refresh_gold_increment(spark, old, kept))

    timed("gold_refresh_with_csv", lambda: refresh_gold(spark, silver, gold, f"{gold}-csv"))

    kept = f"{gold}-kept"
    timed("gold_totals_first", lambda: refresh_gold_increment(spark, silver, kept))
    timed("gold_totals_nothing_new", lambda: refresh_gold_increment(spark, silver, kept))

    print(
        json.dumps(
            {
                "metric": "total seconds of all queries and jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

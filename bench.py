"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from layerkit.operators import checks  # noqa: E402
from layerkit.plans.queries import QUERIES, stored_gold  # noqa: E402
from layerkit.plans.views import Views  # noqa: E402
from layerkit.session import SETTINGS  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 3
ENOUGH = 12.0
HEADLINE = (
    "quality_reason", "silver_valid", "quarantine", "reason_counts", "dup_rank", "surrogate_key", "surrogate_key_bucketed",
    "scd2_build", "scd2_lookup", "scd2_lookup_bucketed", "scd2_lookup_asof", "dim_customer", "lookup_account",
    "fact_transaction", "quality_profile", "unique_keys", "referential_integrity", "scd2_suite", "fact_recheck", "medallion_gold",
    "reasons_by_id", "fact_suite", "source_validation", "medallion_silver",
)


def timed(query: Callable[[], DataFrame]) -> float:
    """Median of up to ``RUNS`` runs; a slow query is run again only while it has taken less than ``ENOUGH`` seconds."""
    taken: list[float] = []
    while not taken or (len(taken) < RUNS and sum(taken) < ENOUGH):
        start = time.perf_counter()
        # The no-op sink computes every row and column without moving them to Python.
        query().write.format("noop").mode("overwrite").save()
        taken.append(time.perf_counter() - start)
    return round(median(taken), 3)


def main() -> None:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{FOLDER}/lineitem.parquet").groupBy("l_returnflag").count().collect()
    # The first query would carry the cold start of its code paths.
    QUERIES[HEADLINE[0]](spark, FOLDER).write.format("noop").mode("overwrite").save()
    seconds = {name: timed(lambda: QUERIES[name](spark, FOLDER)) for name in HEADLINE}
    # The checks alone, on a fact that has been stored.
    fact, source, dims = stored_gold(Views(spark, FOLDER))
    stored = {
        "fact_suite_of_stored": timed(lambda: checks.fact_suite(fact, source, dims)),
        "fact_recheck_of_stored": timed(lambda: checks.fact_recheck(fact, source, dims)),
    }
    spark.stop()
    total = round(sum(seconds.values()), 3)
    queries = {**seconds, **stored}
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": queries, "sf": Path(FOLDER).name}))


if __name__ == "__main__":
    main()

"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bidlens.catalog import queries as catalog  # noqa: E402

HEADLINES = (
    "verdict_summary", "B3_screen", "C1_signal_match", "C5_geo_matches", "C8_discovery_merge", "A1_listing_cards",
    "A2_detail_fields", "A10_document_text", "E2_ranking", "G1_clean", "H13_sentences", "H14_required_documents",
    "C7_change_detection", "M5_detailed",
)


def forget(spark: SparkSession) -> None:
    """Drop plans and stored results shared between queries: each is timed in full."""
    for value in vars(catalog).values():
        if hasattr(value, "cache_clear"):
            value.cache_clear()
    spark.catalog.clearCache()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g")).config("spark.sql.shuffle.partitions", cpus)
        # No call-site capture for every Column: the plans here are large.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINES
    catalog.QUERIES["B6_windows"](spark, folder).write.format("noop").mode("overwrite").save()  # start the executors
    times = {}
    for name in names:
        forget(spark)
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()

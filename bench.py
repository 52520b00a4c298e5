"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession

from fundlake.session import configure
from workloads.queries import ALL

HEADLINE = (
    "multirecord_parse",
    "record_type_counts",
    "typed_decode",
    "date_decode_dutch",
    "quarantine",
    "xml_explode_teldatum",
    "union_drift",
    "keep_first_join",
    "fk_repair_kzd",
    "geo_pivot",
    "bpv_aggregate",
    "kzd_aggregate",
    "obt_base",
    "obt_full",
    "detail_bpv",
    "detail_kzd_amo",
    "detail_bekostiging",
    "meta_leveringen",
    "report_placement_hours",
)


def run(df: DataFrame) -> None:
    """Compute every row and column without keeping the result."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = configure(
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.read.parquet(f"{folder}/lineitem.parquet"))  # start the executor threads
    seconds = {}
    for name in names:
        start = time.perf_counter()
        run(ALL[name](spark, folder))
        seconds[name] = round(time.perf_counter() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total wall time", "value": total, "unit": "sec", "queries": seconds, "sf": folder}))


if __name__ == "__main__":
    main()

"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and cores. Every query is run
to the end into a no-op sink, once to warm up and then BENCH_RUNS times; the median counts.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyspan.plans import QUERIES
from tallyspan.session import clear_scratch, local_session

HEADLINE = [
    "hourly_rollup", "rollup", "re_rollup", "rollup_stream", "rollup_discover_dims",
    "agg_double_sum", "agg_double_last", "agg_filtered", "agg_cardinality_row", "agg_hyper_unique", "agg_histogram", "agg_scripted",
    "post_arithmetic", "post_expression",
    "select_events", "interval_filter", "multi_interval_filter", "filter_and", "filter_not", "filter_value_match",
    "virtual_columns", "time_bucketed_select", "select_paged", "select_paged_desc", "merge_topk", "limit", "order_desc",
    "order_alphanumeric", "extract_regex", "extract_time_format", "extract_lookup",
    "expr_arith", "expr_math_unary", "expr_float_bits", "expr_cast",
    "gran_standard", "gran_period_zone", "gran_compound", "intervals_condense", "intervals_overlap",
    "spatial_polygon", "spatial_join", "ingest_delimited", "ingest_json", "parse_time_auto",
    "jdbc_range_scan", "balanced_ranges", "delimited_encode", "partition_replace", "transfer_audit",
    "catalog_payload", "compare_tables", "column_stats", "config_resolve", "alert_outbox", "alert_size_limit",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    keys = os.environ.get("BENCH_QUERIES", "")
    keys = list(QUERIES) if keys == "all" else keys.split(",") if keys else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")

    def run(key):
        start = time.perf_counter()
        QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took = time.perf_counter() - start
        clear_scratch(spark)
        return took

    seconds = {}
    for key in keys:
        run(key)
        seconds[key] = round(statistics.median(run(key) for _ in range(runs)), 4)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


main()

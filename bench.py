"""Time the headline queries; prints one JSON line.

Each query is run once to warm up and then three times into a sink that consumes every row; the median counts.
The topic logs the queries read are derived from `events` beforehand (`setup`, cold, not part of the value).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidelog.plans import fixture as fx  # noqa: E402
from tidelog.plans.registered import QUERIES  # noqa: E402
from tidelog.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_hourly_counts", "s03_topic_pattern", "s13_start_timestamp", "s18_stop_timestamp", "s28_interleaved",
    "s34_offset_listing", "p03_metadata", "f08_json_decode", "f01_decode_long", "f01_decode_double", "f06_size_headers",
    "f09_debezium", "f09_canal", "u02_latest_by_key", "u03_upsert_changelog", "k16_buffered_upsert", "a01_partition_counters",
    "a03_counters_by_level", "a04_size_histograms", "a05_lag_histogram", "a11_word_count_changelog", "a13_retracting_sum",
    "a14_gaps", "j01_as_of_upsert", "j02_as_of_cdc", "w01_tumble", "w07_late_rows", "w08_merged_watermark", "k01_append", "k11_topic_routing",
]
STREAMS = ["s15_stream_scan", "k04_exactly_once"]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(f) -> float:
    began = time.perf_counter()
    f()
    return time.perf_counter() - began


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    setup = timed(lambda: (fx.topic_log(spark, sf_dir), fx.late_log(spark, sf_dir)))
    seconds, failed = {}, {}
    for name in HEADLINE + STREAMS:
        try:
            consume(QUERIES[name](spark, sf_dir))
            runs = 1 if name in STREAMS else 3
            seconds[name] = statistics.median(timed(lambda: consume(QUERIES[name](spark, sf_dir))) for _ in range(runs))
        except Exception as e:  # one query must not cost the figures of the others
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    seconds = {k: round(v, 3) for k, v in seconds.items()}
    print(json.dumps({
        "metric": "headline queries, total of medians", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "failed": failed, "sf": sf_dir.rsplit("sf", 1)[-1], "setup": round(setup, 3), "cpus": int(cpus), "spark": spark.version,
        "shuffle_partitions": int(cpus), "rows": {"events": fx.table(spark, sf_dir, "events").count(),
                                                  "lineitem": fx.table(spark, sf_dir, "lineitem").count()},
    }))
    spark.stop()


if __name__ == "__main__":
    main()

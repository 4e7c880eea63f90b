"""Time the headline queries: one JSON line on standard output."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from candlewick import build_session  # noqa: E402
from candlewick.plans.catalogue import REGISTRY  # noqa: E402

HEADLINE = [
    "bars",
    "bars_by_supplier",
    "sma",
    "ema",
    "rsi",
    "indicator_set",
    "indicator_set_by_supplier",
    "tick_ema",
    "tick_window_stats",
    "tick_running_vwap",
    "candles_by_minute",
    "candles_from_partials",
    "ticks_from_changes",
    "live_candles_stream",
    "silver_news",
    "rule_matches",
    "lexicon_scores",
    "daily_sentiment",
    "features_with_sentiment",
    "keyed_upsert",
    "fold_rows_anchored",
    "fold_sequences",
    "evaluation",
    "column_profile",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "*")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_SHUFFLE", "16"),
            "spark.driver.memory": "12g",
            # The bench tables are small: without this, merged partitions would leave cores idle.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    REGISTRY["bars"].build(spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM's engines
    seconds = {}
    for name in names:
        began = time.perf_counter()
        REGISTRY[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": Path(sf_dir).name}))


if __name__ == "__main__":
    main()

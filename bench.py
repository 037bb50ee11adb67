"""Headline benchmark: one JSON line with seconds per query.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
Each query runs twice into a no-op sink; the better time counts, so that JVM start-up and
code generation are not measured as query work. Arguments limit the run to the named queries.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time

from pyspark.sql import SparkSession

from tickloom import plans

HEADLINE = [
    "candles_1h", "candles_4h", "candles_adaptive", "candles_indicators", "ewm", "rsi_ewm", "macd", "rsi_sma",
    "rsi_heatmap", "signals", "market_report", "latest_by_key", "incremental_load", "upsert_merge", "gap_ranges",
    "missing_candles", "market_snapshot", "top_volume", "panel_gainers", "spread_daily", "ticker_trend_month",
    "ticker_transform", "order_book_metrics", "ob_trend", "ob_summary_30d", "liquidity_table", "news_transform",
    "news_quality_default", "extract_entities", "clean_text", "intent_labels", "chat_window", "forecast_errors",
    "direction_accuracy", "forecast_overlay", "format_usd", "upsert_months", "scan_base_delta", "stream_ewm",
    "momentum_warmup", "load_candles", "stream_upsert", "latest_bucketed", "candles_from_rollup", "forecast_bars",
    "news_from_index",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = plans.queries()
    names = sys.argv[1:] or HEADLINE
    if names == ["all"]:
        names = list(queries)
    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(json.dumps({
        "metric": "total seconds over headline queries", "value": total, "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    with contextlib.suppress(BrokenPipeError):
        main()

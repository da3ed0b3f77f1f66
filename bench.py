"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion through the ``noop`` sink (the whole plan
executes, nothing is collected to the driver). Three timed runs per query;
the reported time is the median. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Observation  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tradewind.plans import QUERIES  # noqa: E402
from tradewind.session import local_session  # noqa: E402

HEADLINE = [
    "exchange_stats",
    "trade_summary",
    "quality_report",
    "trader_join",
    "enriched_transactions",
    "tier_stats",
    "laundering_share",
    "windowed_trades_batch",
    "windowed_trades_stream",
    "decoded_messages",
    "stream_enrich_sink",
]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    ckpt = tempfile.mkdtemp(prefix="tradewind-bench-")
    extra = {"spark.checkpoint.dir": ckpt}
    event_log = os.environ.get("BENCH_EVENT_LOG_DIR")   # stage/task times, read offline
    if event_log:
        os.makedirs(event_log, exist_ok=True)
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": event_log})
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app_name="tradewind-bench",
                          extra=extra)
    spark.sparkContext.setCheckpointDir(ckpt)
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        runs = []
        for _ in range(RUNS):
            obs = Observation(f"rows_{name}")   # counted by the timed job itself
            t0 = time.perf_counter()
            (QUERIES[name](spark, sf_dir).observe(obs, F.count(F.lit(1)).alias("n"))
             .write.format("noop").mode("overwrite").save())
            runs.append(time.perf_counter() - t0)
            rows[name] = obs.get["n"]
        times[name] = round(statistics.median(runs), 3)
    spark.stop()
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total_median",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "rows": rows,
        # Messages per second through the transaction stream job (table
        # stream -> encode -> decode -> enrich -> partitioned sink); every
        # only rates are the reference feeders' 2 msg/s.
        "stream_enrich_msgs_per_sec": round(rows["stream_enrich_sink"] / times["stream_enrich_sink"])
        if times.get("stream_enrich_sink") else None,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "runs": RUNS,
    }))


if __name__ == "__main__":
    main()

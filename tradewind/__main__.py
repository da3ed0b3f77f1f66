"""Command line for the end-to-end jobs.

    python -m tradewind trade-batch --csv trades.csv --output-path out/by_exchange
    python -m tradewind transaction-batch --csv transactions.csv --output-dir processed
    python -m tradewind transaction-summary --input processed
    python -m tradewind transaction-feed --csv transactions.csv --bootstrap-servers host:9092 --topic transactions
    python -m tradewind trade-stream --bootstrap-servers host:9092 --topic trades --checkpoint ck
    python -m tradewind transaction-stream --bootstrap-servers host:9092 --topic transactions \
        --output-dir processed --checkpoint ck --batch-duration 30

The session comes from ``spark-submit`` / the environment (``getOrCreate``);
results are shown with ``show`` -- small aggregates in full, row-level frames
as a sample.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .plans import jobs

ROW_LEVEL = {"raw", "clean", "joined", "unmatched", "whales", "enriched"}


def _show(frames: dict) -> None:
    for name, df in frames.items():
        print(f"== {name}")
        df.show(5 if name in ROW_LEVEL else 50, truncate=False)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tradewind")
    sub = p.add_subparsers(dest="job", required=True)
    tb = sub.add_parser("trade-batch")
    tb.add_argument("--csv", required=True)
    tb.add_argument("--output-path", required=True)
    xb = sub.add_parser("transaction-batch")
    xb.add_argument("--csv", required=True)
    xb.add_argument("--output-dir", required=True)
    xs = sub.add_parser("transaction-summary")
    xs.add_argument("--input", required=True)
    xf = sub.add_parser("transaction-feed")
    xf.add_argument("--csv", required=True)
    xf.add_argument("--bootstrap-servers", default="localhost:9092")
    xf.add_argument("--topic", default="transactions")
    xf.add_argument("--limit", type=int, default=None)
    ts = sub.add_parser("trade-stream")
    ts.add_argument("--bootstrap-servers", default="localhost:9092")
    ts.add_argument("--topic", default="trades")
    ts.add_argument("--checkpoint", default=None, help="required with --output-path")
    ts.add_argument("--max-offsets-per-trigger", type=int, default=None)
    ts.add_argument("--output-path", default=None, help="omit to print windows to the console")
    ts.add_argument("--output-mode", default="update", choices=["update", "complete"])
    xt = sub.add_parser("transaction-stream")
    xt.add_argument("--bootstrap-servers", default="localhost:9092")
    xt.add_argument("--topic", default="transactions")
    xt.add_argument("--output-dir", required=True)
    xt.add_argument("--checkpoint", required=True)
    xt.add_argument("--batch-duration", type=int, default=30)
    xt.add_argument("--max-offsets-per-trigger", type=int, default=None)
    return p


def main(argv: list[str] | None = None) -> None:
    parser = build_parser()
    a = parser.parse_args(argv)
    if a.job == "trade-stream" and a.output_path and not a.checkpoint:
        parser.error("trade-stream with --output-path needs --checkpoint")

    spark = SparkSession.builder.appName(f"tradewind-{a.job}").getOrCreate()
    if a.job == "trade-batch":
        _show(jobs.trade_batch(spark, a.csv, a.output_path))
    elif a.job == "transaction-batch":
        _show(jobs.transaction_batch(spark, a.csv, a.output_dir))
    elif a.job == "transaction-summary":
        _show(jobs.transaction_summary(spark, a.input))
    elif a.job == "transaction-feed":
        jobs.transaction_feed(spark, a.csv, a.bootstrap_servers, a.topic, a.limit)
    elif a.job == "trade-stream":
        jobs.trade_stream(spark, a.checkpoint, a.output_path, a.bootstrap_servers, a.topic,
                          output_mode=a.output_mode, max_offsets_per_trigger=a.max_offsets_per_trigger).awaitTermination()
    else:
        jobs.transaction_stream(spark, a.output_dir, a.checkpoint, a.bootstrap_servers, a.topic,
                                batch_duration=a.batch_duration, max_offsets_per_trigger=a.max_offsets_per_trigger,
                                on_batch=lambda b, n: print(f"batch {b}: {n} rows")).awaitTermination()


if __name__ == "__main__":
    main()

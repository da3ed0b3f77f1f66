from pyspark.sql import functions as F

from tradewind import sinks
from tradewind.sources import files as src
from tradewind.schemas import TRANSACTION_SCHEMA


def test_declared_schema_keeps_account_strings(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("ts,from_bank,from_account,to_bank,to_account,amount_received,receiving_currency,"
                 "amount_paid,payment_currency,payment_format,is_laundering_flag\n"
                 "2022/09/01 00:20,1,800000,2,0012345,,Euro,5.0,Euro,ACH,0\n"
                 "2022/09/01 00:21,1,1E5,2,0012345,7.5,Euro,5.0,Euro,ACH,1\n")
    df = src.read_csv(spark, str(p), TRANSACTION_SCHEMA)
    rows = df.collect()
    assert [r.from_account for r in rows] == ["800000", "1E5"]
    assert rows[0].to_account == "0012345" and rows[0].amount_received is None
    inferred = src.infer_csv_schema(spark, str(p))
    assert inferred["to_account"].dataType.simpleString() != "string"


def test_write_and_verify(spark, tmp_path):
    df = spark.range(100).withColumn("x", F.col("id") * 2)
    n, back = sinks.write_and_verify(df, str(tmp_path / "out"))
    assert n == 100 and back.count() == 100


def test_partitioned_null_partition_reads_back_null(spark, tmp_path):
    df = spark.createDataFrame([(1, None, "LOW"), (2, 3, "HIGH")], "k int, day_of_week int, amount_category string")
    path = str(tmp_path / "p")
    sinks.write_partitioned(df, path, ["day_of_week", "amount_category"])
    back = {r.k: r for r in sinks.read_partitioned(spark, path).collect()}
    assert back[1].day_of_week is None and back[2].day_of_week == 3
    # Partition pruning reaches the scan.
    plan = sinks.read_partitioned(spark, path).filter("amount_category = 'LOW'")._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters" in plan and "LOW" in plan


def test_csv_roundtrip_keeps_microseconds(spark, tmp_path):
    from datetime import datetime
    df = spark.createDataFrame([(datetime(2024, 1, 1, 0, 0, 7, 179575), None)], "t timestamp_ntz, s string")
    sinks.write_csv(df, str(tmp_path / "c"))
    back = spark.read.schema("t timestamp_ntz, s string").option("header", True) \
        .option("timestampNTZFormat", sinks.CSV_TIMESTAMP_FORMAT).csv(str(tmp_path / "c")).first()
    assert back.t == datetime(2024, 1, 1, 0, 0, 7, 179575) and back.s is None


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    assert src.schema_report(df) == [("a", "int"), ("b", "string")]

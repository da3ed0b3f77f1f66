import pytest
from pyspark.sql import types as T

from tradewind.sources.decode import decode_messages, decode_transactions
from tradewind.operators.enrich import enrich_transactions

SCHEMA = T.StructType([
    T.StructField("ts", T.StringType()),
    T.StructField("bank", T.IntegerType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("name", T.StringType()),
])


def _decode(spark, values, normalize_nan=True):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    out = decode_messages(df, SCHEMA, required="ts", keep_columns=["i"], normalize_nan=normalize_nan)
    return {r.i: r for r in out.collect()}


def test_truth_table(spark):
    msgs = [
        '{"ts":"a","bank":1,"amount":2.5,"name":"x"}',        # 0 valid
        '{"ts":"a","bank":1,"amount":2.5,"extra":9}',         # 1 extra field ignored
        'not json',                                           # 2
        '{"ts":"a","bank":1',                                 # 3 truncated
        '',                                                   # 4 empty
        None,                                                 # 5 null
        '{"bank":1,"amount":2.5}',                            # 6 required missing
        '{"ts":"a","bank":"","amount":""}',                   # 7 "" for int and double
        '{"ts":"a","bank":10.0}',                             # 8 10.0 for int
        '{"ts":"a","bank":99999999999}',                      # 9 int overflow
        '{"ts":"a","name":123}',                              # 10 number for string
        '{"ts":"a","amount":NaN}',                            # 11 bare NaN
        '[{"ts":"a"}]',                                       # 12 top-level array
    ]
    got = _decode(spark, msgs)
    assert set(got) == {0, 1, 7, 8, 9, 10, 11}
    assert got[0].bank == 1 and got[0].amount == 2.5 and got[0].name == "x"
    assert got[1].bank == 1 and got[1].name is None
    assert got[7].bank is None and got[7].amount is None and got[7].ts == "a"
    assert got[8].bank is None
    assert got[9].bank is None
    assert got[10].name == "123"
    assert got[11].amount is None          # NaN normalised to null (D5)


def test_bare_nan_kept_without_normalisation(spark):
    got = _decode(spark, ['{"ts":"a","amount":NaN}'], normalize_nan=False)
    import math
    assert math.isnan(got[0].amount)


def test_empty_required_string_passes_then_parses_null(spark):
    df = spark.createDataFrame([('{"Timestamp":"","Amount Received":5.0}',)], "value string")
    out = enrich_transactions(decode_transactions(df)).collect()
    assert len(out) == 1 and out[0].event_timestamp is None and out[0].amount_category == "LOW"


def test_binary_value_is_cast(spark):
    df = spark.createDataFrame([(bytearray(b'{"ts":"a","bank":3}'),)], "value binary")
    r = decode_messages(df, SCHEMA, required="ts").first()
    assert r.ts == "a" and r.bank == 3


def test_raw_csv_and_persisted(spark, tmp_path):
    from tradewind.sources import files as src
    from tradewind.session import persisted
    p = tmp_path / "raw.csv"
    p.write_text("Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,"
                 "Amount Paid,Payment Currency,Payment Format,Is Laundering\n"
                 "2022/09/01 00:20,10,0012345,20,1E5,12000.5,Euro,12000.5,Euro,ACH,1\n")
    with persisted(src.read_raw_transactions_csv(spark, str(p))) as df:
        r = enrich_transactions(df).first()
        assert df.is_cached
    assert (r.from_account, r.to_account, r.amount_category, r.is_laundering) == ("0012345", "1E5", "HIGH", "Yes")
    assert (r.hour_of_day, r.day_of_week) == (0, 5)


WIRE = (b'{"Timestamp": "2022/09/01 00:20", "From Bank": 10, "Account": "8000EBD30", "To Bank": 20, "Account.1": "8000EBD31", '
        b'"Amount Received": 12000.5, "Receiving Currency": "Euro", "Amount Paid": 12000.5, "Payment Currency": "Euro", '
        b'"Payment Format": "ACH", "Is Laundering": 1, "kafka_timestamp": "2026-01-01T00:00:00.000001"}')


def test_wire_message_is_decoded(spark):
    from tradewind.sources.decode import decode_report
    from tradewind.schemas import TRANSACTION_WIRE_SCHEMA
    rows = spark.createDataFrame([(bytearray(WIRE),), (bytearray(b'{"ts": "2022/09/01 00:20"}'),), (bytearray(b"{"),), (None,)], "value binary")
    out = enrich_transactions(decode_transactions(rows)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.ts, r.from_bank, r.from_account, r.to_bank, r.to_account) == ("2022/09/01 00:20", 10, "8000EBD30", 20, "8000EBD31")
    assert (r.amount_received, r.payment_format, r.is_laundering, r.amount_category, r.hour_of_day) == (12000.5, "ACH", "Yes", "HIGH", 0)
    assert tuple(decode_report(rows, TRANSACTION_WIRE_SCHEMA, "Timestamp").first()) == (4, 3)


def test_wire_message_with_empty_text_for_a_number(spark):
    rows = spark.createDataFrame([('{"Timestamp": "2022/09/01 00:20", "Amount Received": "", "Account": "A"}',)], "value string")
    r = decode_transactions(rows).first()
    assert r.amount_received is None and r.from_account == "A"


@pytest.mark.parametrize("second", ["Account", "Account.1"])
def test_csv_columns_are_found_by_name(spark, tmp_path, second):
    from tradewind.sources import files as src
    p = tmp_path / "raw.csv"
    p.write_text(f"Amount Paid,Account,Is Laundering,From Bank,{second},To Bank,Amount Received,Payment Format,Timestamp,"
                 "Receiving Currency,Payment Currency\n10,A1,0,1,B1,2,12000,ACH,2022/09/01 00:20,Euro,Yen\n")
    r = src.read_raw_transactions_csv(spark, str(p)).first()
    assert (r.ts, r.from_account, r.to_account, r.amount_received, r.amount_paid) == ("2022/09/01 00:20", "A1", "B1", 12000.0, 10.0)
    assert (r.receiving_currency, r.payment_currency, r.from_bank, r.to_bank) == ("Euro", "Yen", 1, 2)


def test_csv_without_a_column_is_refused(spark, tmp_path):
    from tradewind.sources import files as src
    p = tmp_path / "raw.csv"
    p.write_text("Timestamp,From Bank\n2022/09/01 00:20,1\n")
    with pytest.raises(ValueError, match="Account"):
        src.read_raw_transactions_csv(spark, str(p))


def test_kafka_options_and_ingest_stamp(spark):
    import json
    from tradewind.sources.kafka import kafka_options
    from tradewind.sinks.kafka import DEFAULT_PRODUCER_OPTIONS
    from tradewind.operators import encode_transactions, encode_trades
    o = kafka_options("broker:9092", "transactions", maxOffsetsPerTrigger=1000)
    assert o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
    assert o["subscribe"] == "transactions" and o["maxOffsetsPerTrigger"] == "1000"
    assert DEFAULT_PRODUCER_OPTIONS["kafka.acks"] == "all"
    df = spark.createDataFrame([("2022/09/01 00:20", 7, None)], "ts string, from_bank int, amount_received double")
    m = encode_transactions(df).first()
    body = json.loads(m.value)
    assert m.key == "7" and "Amount Received" not in body and body["From Bank"] == 7
    assert len(body["kafka_timestamp"]) == 26 and body["kafka_timestamp"][10] == "T"
    assert encode_trades(df).first().key is None


def test_stream_adds_processing_time(spark, tmp_path):
    from tradewind import streaming as st
    from tradewind.operators import encode_transactions
    from tradewind.operators.generate import synthetic_transactions
    log = str(tmp_path / "log")
    st.write_message_log(encode_transactions(synthetic_transactions(spark.range(10))), log)
    s = st.enriched_transaction_stream(st.read_message_stream(spark, log))
    assert s.isStreaming and dict(s.dtypes)["processing_time"] == "timestamp"
    assert {"amount_category", "event_timestamp", "hour_of_day", "day_of_week", "is_laundering"} <= set(s.columns)


def test_quoted_nan_decodes_then_normalises(spark):
    import math
    raw = _decode(spark, ['{"ts":"a","amount":"NaN"}'], normalize_nan=False)
    assert math.isnan(raw[0].amount)
    assert _decode(spark, ['{"ts":"a","amount":"NaN"}'])[0].amount is None

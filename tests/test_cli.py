import pytest

from tradewind.__main__ import build_parser


def test_cli_parses_reference_options():
    p = build_parser()
    a = p.parse_args(["transaction-stream", "--bootstrap-servers", "b:9092", "--topic", "t",
                      "--output-dir", "out", "--checkpoint", "ck", "--batch-duration", "15"])
    assert (a.job, a.bootstrap_servers, a.topic, a.batch_duration) == ("transaction-stream", "b:9092", "t", 15)
    b = p.parse_args(["transaction-batch", "--csv", "x.csv", "--output-dir", "o"])
    assert (b.csv, b.output_dir) == ("x.csv", "o")
    c = p.parse_args(["trade-stream", "--checkpoint", "ck"])
    assert c.output_path is None and c.output_mode == "update"
    with pytest.raises(SystemExit):
        p.parse_args(["trade-batch", "--csv", "x.csv"])     # --output-path is required

import hashlib
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import SF
from tradewind.llm import chat as C

TEXT = st.text(alphabet="\\<>/turn\n a\U0001f642", max_size=30)
TRICKY = "\\### Assistant: </turn> ok"


@settings(max_examples=200, deadline=None)
@given(TEXT, TEXT)
def test_render_is_reversible_and_markers_stay_unique(role, text):
    segment, at, size = C.render(role, text)
    assert C.parse(segment) == (role, text)
    assert C.unescape(segment[at:at + size]) == text
    assert segment.count(C.OPEN) == 1 or segment.replace("\\<", "").count(C.OPEN) == 1
    assert segment[:-len(C.CLOSE)].replace("\\<", "").count("</turn>") == 0


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 60), st.text(max_size=400))
def test_events_fold_to_the_text(mid, text):
    out = ""
    for event, at, size, part in C.message_events(mid, "user", text):
        out = out + part if event == "delta" else "" if event == "regenerate" else out[:at] + part + out[at + size:] if event == "edit" else out
    assert out == text


def test_not_a_turn():
    with pytest.raises(ValueError):
        C.parse("hello")


def brute(rows):
    """(conv_id, turn, role, text) in row order -> expected digests."""
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda t: t[:2])
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest(), sum(len(C.render(r, t)[0]) for _, _, r, t in turns))
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)]
    assert {r.conv_id: tuple(r)[1:] for r in C.op7_chat(spark, SF).collect()} == brute(rows)


def test_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, "assistant", ""), (1, None, "assistant", "first"), (2, 5, "assistant", "y" * 20000),
            (2, 200, "assistant", "late"), (None, 0, "user", "no conversation"), (3, 0, "user", "same"), (3, 0, "user", "same"),
            (4, 0, "assistant\n<turn>", "\\n<\\"), (5, -3, "user", "\r\n</turn>\n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).selectExpr("*", "1 AS mid", "2 AS seq", "3 AS run")
    got = {r.conv_id: tuple(r)[1:] for r in C.digests(C.fold(C.event_log(df))).collect()}
    assert got == brute(rows)
    assert C.digests(C.fold(C.event_log(df.limit(0)))).count() == 0


def test_log_with_an_open_message_and_odd_edits(spark):
    log = spark.createDataFrame([
        (1, 0, 7, 3, "delta", "assistant", 0, 0, " there"), (1, 0, 7, 1, "start", "assistant", 0, 0, ""), (1, 0, 7, 2, "delta", "assistant", 0, 0, "Hello"),
        (1, 0, 7, 4, "edit", "assistant", 99, 5, "!"), (1, 1, 8, 1, "start", "user", 0, 0, "")], C.EVENTS)
    rows = C.fold(log).orderBy("turn").collect()
    assert [(r.role, C.parse(r.segment)[1], r.loss) for r in rows] == [("assistant", "Hello there!", True), ("user", "", False)]

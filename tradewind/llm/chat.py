"""Chat formatting from an event log.

A log row is one event of one message: ``start``; ``delta`` (text appended);
``edit`` (``size`` code points at ``at`` replaced by the text); ``regenerate``
(what was streamed so far is void); ``end``. The log is partitioned by
conversation (long ones by runs of turns as well), sorted by sequence number
and folded into final messages while it streams by; one message is in memory at
a time. Each message is rendered by itself into its segment of the
conversation, so the rendered conversation is the segments in order.

Template of a turn: ``<turn>role``, line break, text, ``</turn>``, line break.
Inside texts and roles, ``\\`` is written ``\\\\`` and ``<`` is written ``\\<``
(and a line break in a role ``\\n``), so a marker never occurs in them.
"""
from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import read, shuffle_partitions

OPEN, CLOSE = "<turn>", "</turn>\n"
ASSISTANT = "assistant"
RUN = 64        # turns of one conversation that are folded by one task
PIECE = 160     # code points of a streamed delta, in the derived log

_ESCAPED = re.compile(r"\\(.)", re.S)

EVENTS = "conv_id long, turn long, mid long, seq long, event string, role string, at int, size int, text string"


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\<")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn's segment, and where its escaped text starts and how long it is."""
    head = OPEN + escape(role).replace("\n", "\\n") + "\n"
    body = escape(text)
    return head + body + CLOSE, len(head), len(body)


def parse(segment: str) -> tuple[str, str]:
    """Role and text of a rendered turn."""
    if not segment.startswith(OPEN) or not segment.endswith(CLOSE):
        raise ValueError("not a rendered turn")
    role, text = segment[len(OPEN):-len(CLOSE)].split("\n", 1)
    return unescape(role), unescape(text)


def message_events(mid: int, role: str, text: str):
    """A log that ends in ``text``: streamed in pieces; some messages are first
    drafted and regenerated, some streamed with a slip that an edit mends."""
    yield "start", 0, 0, ""
    if mid % 3 == 0:
        yield "delta", 0, 0, text[::-1][:PIECE]
        yield "delta", 0, 0, "draft <"
        yield "regenerate", 0, 0, ""
    slip = len(text) // 2 if mid % 4 == 1 else None
    for i in range(0, len(text), PIECE):
        piece = text[i:i + PIECE]
        if slip is not None and i <= slip < i + PIECE:
            piece = piece[:slip - i] + "\\slip" + piece[slip - i:]
        yield "delta", 0, 0, piece
    if slip is not None and text:
        yield "edit", slip, 5, ""
    if mid % 5 == 2 and text:
        yield "edit", 0, 1, "?"
        yield "edit", 0, 1, text[0]
    yield "end", 0, 0, ""


def event_log(df: DataFrame) -> DataFrame:
    """The log of conversations given as messages (conv_id, turn, role, text).
    Null roles and texts are empty; equal turns keep the order of their rows."""
    rows = df.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                     F.monotonically_increasing_id().alias("mid"),
                     F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))

    def run(batches):
        import pyarrow as pa
        names = [c.split()[0] for c in EVENTS.split(", ")]
        kinds = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()]
        for b in batches:
            out = []
            for conv, turn, mid, role, text in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                for i, (event, at, size, part) in enumerate(message_events(mid, role, text)):
                    out.append((conv, turn, mid, i, event, role, at, size, part))
                if len(out) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out = []
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, EVENTS)


def fold(log: DataFrame) -> DataFrame:
    """Final, rendered messages: ``conv_id``, ``turn``, ``mid``, ``role``,
    ``segment``, ``text_at``, ``text_size``, ``loss`` (whether the text is
    under the loss mask).

    A message without an ``end`` is still open and is rendered as far as it
    came. An edit beyond the end of the text is cut to it. Null conversations
    are one conversation; null turns sort first."""
    run_of = F.floor(F.col("turn") / RUN)
    n = shuffle_partitions(log.sparkSession)
    rows = log.withColumn("run", run_of).repartition(n, "conv_id", "run").sortWithinPartitions("conv_id", "run", "turn", "mid", "seq")

    def run(batches):
        import pyarrow as pa
        names = ["conv_id", "turn", "mid", "role", "segment", "text_at", "text_size", "loss"]
        kinds = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.bool_()]
        key, role, parts, out = None, "", [], []

        def close():
            if key is not None:
                segment, at, size = render(role, "".join(parts))
                out.append((*key, role, segment, at, size, role == ASSISTANT))

        def flush():
            cols = list(zip(*out, strict=True)) or [()] * len(names)
            batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)
            out.clear()
            return batch

        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("conv_id", "turn", "mid", "event", "role", "at", "size", "text")]
            for conv, turn, mid, event, who, at, size, text in zip(*cols, strict=True):
                if (conv, turn, mid) != key:
                    close()
                    key, role, parts = (conv, turn, mid), who, []
                if event == "delta":
                    parts.append(text)
                elif event == "regenerate":
                    parts = []
                elif event == "edit":
                    whole = "".join(parts)
                    parts = [whole[:at], text, whole[at + size:]]
            yield flush()
        close()
        yield flush()

    return rows.mapInArrow(run, "conv_id long, turn long, mid long, role string, segment string, text_at int, text_size int, loss boolean")


def digests(rendered: DataFrame) -> DataFrame:
    """Per conversation, read back from its segments in order: ``conv_id``,
    ``n_turns``, ``turns_sha256``, ``loss_chars``, ``loss_sha256``,
    ``formatted_chars``. A digest is taken over a stream, so a conversation of
    any size is hashed segment by segment, never gathered."""
    rows = rendered.select("conv_id", "turn", "mid", "segment", "text_at", "text_size", "loss")
    rows = rows.repartition(shuffle_partitions(rendered.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "mid")

    def run(batches):
        import pyarrow as pa
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        none, out = object(), []
        key, state = none, None

        def close():
            if key is not none:
                out.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for b in batches:
            for conv, segment, at, size, loss in zip(*(b.column(c).to_pylist() for c in ("conv_id", "segment", "text_at", "text_size", "loss")), strict=True):
                if conv != key or key is none:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
                if loss:
                    masked = unescape(segment[at:at + size])
                    state[2] += len(masked)
                    state[3].update(masked.encode("utf-8", "surrogatepass"))
                state[4] += len(segment)
        close()
        cols = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)

    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op7_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations, and number -7 whose texts hold the template's own
    control strings, through the event log and back."""
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", tricky), (-7, 1, "assistant", tricky)], "conv_id long, turn long, role string, text string")
    given = read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return digests(fold(event_log(given.unionByName(extra))))

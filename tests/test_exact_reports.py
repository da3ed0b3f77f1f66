"""Lost offsets, percentiles, heavy hitters, subtotals and checksums against plain Python."""
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tradewind.operators.heavy_hitters import heavy_hitters, summaries
from tradewind.operators.selection import exact_percentiles
from tradewind.operators.stats import frequency_profile
from tradewind.operators.subtotals import subtotals
from tradewind.sinks import checksum as C
from tradewind.sources.offsets import lost_ranges


def test_lost_ranges_over_many_tasks(spark):
    rng = random.Random(3)
    held = {0: [o for o in range(5000) if rng.random() > 0.02 and not 1000 <= o < 1900], 7: [5], 8: [1, 9], 9: list(range(100, 200))}
    rows = [(p, o) for p, os in held.items() for o in os] + [(0, o) for o in held[0][::3]] + [(None, 1), (1, None)]
    rng.shuffle(rows)
    got = lost_ranges(spark.createDataFrame(rows, "partition int, offset long").repartition(5)).collect()
    want = [(p, a + 1, b - 1, b - a - 1) for p, os in held.items() for a, b in zip(os, os[1:], strict=False) if b - a > 1]
    assert sorted(map(tuple, got)) == sorted(want)
    assert lost_ranges(spark.createDataFrame([], "partition int, offset long")).count() == 0


PROBS = [0.0, 0.001, 0.1, 0.5, 0.77, 0.999, 1.0]


def _disc(values, p):
    values = sorted(values)
    return values[max(1, len(values) - math.floor(len(values) - p * len(values))) - 1]


@pytest.mark.parametrize("bins,few", [(4096, 10_000), (256, 5)])
def test_percentiles(spark, bins, few):
    rng = random.Random(5)
    groups = {"wide": [rng.choice([-1, 1]) * 10 ** rng.uniform(-300, 300) for _ in range(500)], "same": [2.5] * 300, "one": [7.0],
              "ties": [float(rng.randrange(6)) for _ in range(400)], None: [rng.gauss(0, 1) for _ in range(333)],
              "inf": [float("inf")] * 5 + [float("-inf")] * 3 + [1.0, 2.0], "all": [float("inf")] * 4, "huge": [1.7e308, -1.7e308, 0.0, 1e-320]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("one", None), ("one", float("nan")), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {(r.g, r.prob): r.value for r in exact_percentiles(df, ["g"], "v", PROBS, bins, few).collect()}
    assert got == {(g, p): _disc(vs, p) for g, vs in groups.items() for p in PROBS}


def test_percentiles_without_groups_or_rows(spark):
    df = spark.range(101).select(F.col("id").cast("int").alias("v"))
    assert sorted(tuple(r) for r in exact_percentiles(df, [], "v", [0.5, 0.25]).collect()) == [(0.25, 25.0), (0.5, 50.0)]
    assert exact_percentiles(df.limit(0), [], "v", [0.5]).count() == 0
    with pytest.raises(ValueError):
        exact_percentiles(df, [], "v", [1.5])


def test_heavy_hitters(spark):
    rng = random.Random(7)
    values = [f"h{k}" for k in range(8) for _ in range(900 - 50 * k)] + [f"r{rng.randrange(10**9)}" for _ in range(6000)] + [None] * 50
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "bank string").repartition(6)
    for capacity, top in ((64, 5), (16, 8), (2, 3), (4096, 20)):
        got = [tuple(r) for r in heavy_hitters(df, "bank", top, capacity).collect()]
        assert got == [tuple(r) for r in frequency_profile(df, "bank", top).collect()]
    # A value in no summary occurs no more often than the bound.
    rows = summaries(df, "bank", 64).collect()
    bound = sum(r.n for r in rows if r.value is None)
    kept = {r.value for r in rows}
    assert len(rows) <= 6 * 65 and all(n <= bound for v, n in Counter(values).items() if v is not None and v not in kept)
    flat = spark.range(500).select((F.col("id") % 250).cast("string").alias("bank"))  # nothing is heavy
    assert heavy_hitters(flat, "bank", 3, 4, 64).collect() == frequency_profile(flat, "bank", 3).collect()
    assert heavy_hitters(flat.limit(0), "bank", 3).count() == 0


def test_subtotals_tell_totals_from_nulls(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), (None, 1, 4.0), (None, None, None)], "x string, y int, v double")
    got = {tuple(r) for r in subtotals(df, ["x", "y"], [["x", "y"], ["x"], []], "v").collect()}
    assert got == {("a", 1, 0, 1, 1.0), ("a", None, 0, 1, 2.0), (None, 1, 0, 1, 4.0), (None, None, 0, 1, None),
                   ("a", None, 1, 2, 3.0), (None, None, 1, 2, 4.0), (None, None, 3, 4, 7.0)}
    with pytest.raises(ValueError):
        subtotals(df, ["x"], [["z"]], "v")


def test_checksum_sees_every_change(spark, tmp_path):
    rows = [(1, "a", 1.5), (2, None, 2.5), (3, "c", None), (3, "c", None)]
    schema = "k int, s string, v double"
    df = spark.createDataFrame(rows, schema)
    path = str(tmp_path / "t")
    given = C.write_with_checksum(df, path)
    assert given.rows == 4 and given == C.checksum(df.repartition(3)) and C.verify_contents(spark, path, df.schema, given).count() == 4
    for other in ([(1, "a", 1.5), (2, None, 2.5), (3, "c", None)], [(1, "a", 1.5), (2, None, 2.5), (3, "c", 0.0), (3, "c", None)],
                  [(1, "a", 1.5), (2, "", 2.5), (3, "c", None), (3, "c", None)], [(1, "a", 1.5), (2, None, 2.5), (2, None, 2.5), (3, "c", None)]):
        spark.createDataFrame(other, schema).write.mode("overwrite").parquet(path)
        with pytest.raises(RuntimeError):
            C.verify_contents(spark, path, df.schema, given)
    swapped = spark.createDataFrame([(None, "a")], "p string, q string")
    assert C.checksum(swapped) != C.checksum(swapped.select(F.col("q").alias("p"), F.col("p").alias("q")))
    assert C.checksum(df.limit(0)) == C.Checksum(0, 0, 0)

"""Measures loaded in 1, 2 and 10 increments equal one pass over all rows."""

import random

import pytest

from hoopline.operators.increments import advance
from hoopline.operators.windows import Measure, over_rows, to_date, trailing

MEASURES = [
    Measure("ppg", "avg", "pts", to_date(), 6),
    Measure("sd", "stddev", "pts", to_date(), 6),
    Measure("sd_now", "stddev", "pts", to_date(True), 6),
    Measure("last3", "avg", "pts", trailing(3), 6),
    Measure("sum2", "sum", "pts", trailing(2, True)),
    Measure("prev", "lag", "pts"),
]


def _rows(spark):
    rnd = random.Random(5)
    rows = []
    for day in range(40):
        for key in ["a", "b", None] + (["hot"] * 3 if day % 2 else []):
            pts = None if rnd.random() < 0.1 else rnd.randint(0, 40) + 0.0
            rows.append((key, day, len(rows), pts, "x"))
    # a column named like the operator's own
    return spark.createDataFrame(rows, "k string, day int, seq int, pts double, __lead_in string")


@pytest.mark.parametrize("steps", [1, 2, 10])
def test_increments_equal_one_pass(spark, steps):
    df = _rows(spark)
    expected = sorted(over_rows(df, ["k"], ["day", "seq"], MEASURES).drop("__lead_in").collect(), key=lambda r: r.seq)
    state, got = None, []
    for i in range(steps):
        part = df.filter(f"day * {steps} div 40 = {i}")
        measured, state = advance(state, part, ["k"], ["day", "seq"], MEASURES)
        got += measured.drop("__lead_in").collect()
    got.sort(key=lambda r: r.seq)
    assert len(got) == len(expected) == df.count()
    for g, e in zip(got, expected):
        for name in ["k", "day", "seq", "ppg", "sd", "sd_now", "last3", "sum2", "prev"]:
            a, b = g[name], e[name]
            assert (a is None and b is None) or a == pytest.approx(b, abs=1e-6), (name, g, e)


def test_empty_load_keeps_state(spark):
    df = _rows(spark)
    measured, state = advance(None, df.filter("day < 5"), ["k"], ["day", "seq"], MEASURES)
    empty, same = advance(state, df.filter("false"), ["k"], ["day", "seq"], MEASURES)
    assert empty.count() == 0
    assert sorted(map(tuple, same.totals.collect()), key=str) == sorted(map(tuple, state.totals.collect()), key=str)

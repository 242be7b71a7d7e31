import random

import pytest
from pyspark.sql import functions as F

from hoopline.operators import windows
from hoopline.operators.windows import (
    Measure,
    find_hot,
    latest_rows,
    over_rows,
    to_date,
    trailing,
)

MEASURES = [
    Measure("avg3", "avg", "v", trailing(3), 4),
    Measure("std3", "stddev", "v", trailing(3), 4),
    Measure("avg3c", "avg", "v", trailing(3, True), 4),
    Measure("run_avg", "avg", "v", to_date(), 4),
    Measure("run_std", "stddev", "v", to_date(), 4),
    Measure("run_sum", "sum", "v", to_date(), 4),
    Measure("run_sum_c", "sum", "v", to_date(True), 4),
    Measure("prev", "lag", "d"),
]


def frame(spark, rows, partitions=5):
    return spark.createDataFrame(rows, "k string, j int, d int, v double").repartition(partitions)


def skewed_rows(seed=3):
    rng = random.Random(seed)
    rows = [("hot", 1, rng.randint(0, 40), float(rng.randint(0, 30))) for _ in range(700)]
    rows += [("copies", 1, 7, 5.0)] * 400
    rows += [(f"k{i % 40}", i % 2, rng.randint(0, 40), float(rng.randint(0, 30))) for i in range(400)]
    rows += [(None, None, rng.randint(0, 40), rng.choice([None, 1.0, 2.0])) for _ in range(150)]
    return rows


def as_sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [60, 7, 2])
def test_split_keys_give_the_plain_result(spark, limit):
    df = frame(spark, skewed_rows())
    plain = over_rows(df, ["k", "j"], ["d", "v"], MEASURES)
    split = over_rows(df, ["k", "j"], ["d", "v"], MEASURES, rows_per_task=limit)
    assert split.columns == plain.columns
    assert as_sorted(split) == as_sorted(plain)


def test_split_keys_match_brute_force(spark):
    rows = skewed_rows(11)
    got = over_rows(frame(spark, rows), ["k", "j"], ["d", "v"], MEASURES, rows_per_task=50)
    groups = {}
    for k, j, d, v in rows:
        groups.setdefault((k, j), []).append((d, v))
    expected = []
    for key, values in groups.items():
        values.sort(key=lambda x: (x[0], x[1] is not None, x[1] or 0))
        for i, (d, v) in enumerate(values):
            before = [x for _, x in values[:i] if x is not None]
            last = [x for _, x in values[max(0, i - 3) : i] if x is not None]
            expected.append(
                (
                    *key,
                    d,
                    v,
                    round(sum(last) / len(last), 4) if last else None,
                    round(sum(before), 4) if before else None,
                    values[i - 1][0] if i else None,
                )
            )
    picked = got.select("k", "j", "d", "v", "avg3", "run_sum", "prev")
    assert as_sorted(picked) == sorted(expected, key=repr)


def test_find_hot_counts_key_sets_in_one_pass(spark):
    df = frame(spark, skewed_rows())
    by_both, by_j = find_hot(df, ["k", "j"], ["j"], rows_per_task=300)
    assert {tuple(r) for r in by_both.keys.collect()} == {("hot", 1), ("copies", 1)}
    assert by_both.total == 1100
    assert [r[0] for r in by_j.keys.collect()] == [1]
    assert find_hot(df, ["k"], rows_per_task=10_000)[0].keys is None


def test_excluding_frames_ignore_the_current_value(spark):
    rows = [("a", 1, i, float(i % 5)) for i in range(12)]
    changed = [(k, j, d, 99.0 if d == 11 else v) for k, j, d, v in rows]
    last = lambda r: (
        over_rows(frame(spark, r), ["k"], ["d"], MEASURES[:2] + MEASURES[3:6])
        .filter("d = 11")
        .drop("v")
        .collect()
    )
    assert last(rows) == last(changed)


def test_one_row_stddev_and_first_row_are_null(spark):
    out = over_rows(frame(spark, [("a", 1, 1, 4.0), ("a", 1, 2, 6.0)]), ["k"], ["d"], MEASURES)
    first, second = out.orderBy("d").collect()
    assert first["avg3"] is None and first["run_sum"] is None and first["std3"] is None
    assert second["avg3"] == 4.0 and second["std3"] is None and second["run_std"] is None


def test_latest_rows(spark):
    df = frame(spark, [("a", 1, d, 1.0) for d in range(5)] + [("b", 1, 9, 2.0)])
    got = {(r.k, r.d) for r in latest_rows(df, ["k"], ["d"], 2).collect()}
    assert got == {("a", 4), ("a", 3), ("b", 9)}
    plan = latest_rows(df, ["k"], ["d"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_a_key_of_600_000_rows_is_split_and_its_rows_are_stored_once(spark, monkeypatch):
    df = spark.range(600_000).select(F.lit("a").alias("k"), F.col("id").alias("d"))
    (hot,) = find_hot(df, ["k"])
    assert hot.keys is not None and hot.total == 600_000
    stored, real = [], windows.stage
    monkeypatch.setattr(windows, "stage", lambda rows, label: stored.append(label) or real(rows, label))
    got = over_rows(df, ["k"], ["d"], [Measure("prev", "lag", "d")], hot=hot)
    assert got.filter("prev = d - 1").count() == 599_999 and got.count() == 600_000
    assert sorted(stored) == ["busy-blocks", "window-input"]

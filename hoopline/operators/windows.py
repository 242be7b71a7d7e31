"""Row-frame windows that stay distributed when single keys hold a large share of the rows.

A SQL window puts every row of a partition key into one task. That is the right plan while each key
has a bounded number of rows, so it is the plan used for those keys. Keys above ``ROWS_PER_TASK`` are
found first with one map-side-combined count (``find_hot``) and take another way:

1. their rows are range-partitioned on (key, order, salt), so a hot key spans many partitions;
2. per-partition row counts, summed in order, give each row its exact position within its key;
3. positions are cut into chunks of equal length, and each chunk also receives the last few rows of
   the chunk before it, as many as the longest trailing frame needs;
4. trailing frames are ordinary windows within a chunk, and running frames add the totals of the
   earlier chunks of the key to an ordinary running window within the chunk.

Only the columns that a window reads take that way, with the number of their row. What it adds is stored and joined by
that number, so wide rows are stored once and dealt once, not at every step.

Both ways give the same values; no row is dropped or sampled.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoopline.session import stage

# Rows of one key that a single task sorts without trouble: of some 300 bytes each, and a task gets several keys.
ROWS_PER_TASK = 500_000
# Blocks that rows are cut into at most while a block holds fewer rows than that: a task for a few hundred rows costs
# more than it sorts.
MAX_BLOCKS = 1000


def rows_per_block(total: int, rows_per_task: int) -> int:
    """``rows_per_task``, or more where that would cut ``total`` rows into over ``MAX_BLOCKS`` small blocks."""
    return max(rows_per_task, min(ceil(total / MAX_BLOCKS), ROWS_PER_TASK))


@dataclass(frozen=True)
class RowFrame:
    """ROWS BETWEEN ``start`` AND ``end``, relative to the current row; None is the first row."""

    start: int | None
    end: int


def trailing(n: int, include_current: bool = False) -> RowFrame:
    """The last ``n`` rows, before the current row or ending with it."""
    return RowFrame(-(n - 1), 0) if include_current else RowFrame(-n, -1)


def to_date(include_current: bool = False) -> RowFrame:
    """All rows so far, before the current row or ending with it."""
    return RowFrame(None, 0 if include_current else -1)


@dataclass(frozen=True)
class Measure:
    """One output column: ``how`` is avg, stddev, sum or lag (of one row)."""

    name: str
    how: str
    column: str
    frame: RowFrame = RowFrame(-1, -1)
    digits: int | None = None

    def finish(self, value: Column) -> Column:
        return value if self.digits is None else F.round(value, self.digits)


@dataclass(frozen=True)
class HotKeys:
    """Keys whose rows need more than one task: a stored table of them, and the rows of all together.

    The table has one column ``__hot<i>`` for each of ``columns``; it is None if no key is hot.
    """

    columns: tuple[str, ...]
    keys: DataFrame | None = None
    total: int = 0


_AGGREGATE = {"avg": F.avg, "stddev": F.stddev_samp, "sum": F.sum, "lag": F.first}


def find_hot(
    df: DataFrame, *key_sets: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> list[HotKeys]:
    """Count rows for all ``key_sets`` in one job and keep the keys above ``rows_per_task`` as a table.

    The count reads only the key columns and combines before it shuffles. Every hot key is kept,
    however many there are; one row of totals per key set comes back.
    """
    names = list(dict.fromkeys(k for keys in key_sets for k in keys))
    counted = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(names)])
    position = {k: f"k{i}" for i, k in enumerate(names)}
    sets = [[position[k] for k in keys] for keys in key_sets]
    counts = counted.groupingSets(sets, *position.values()).agg(
        F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid")
    )
    top = stage(counts.filter(F.col("n") > rows_per_task), "hot-keys")
    totals = {r["gid"]: r["total"] for r in top.groupBy("gid").agg(F.sum("n").alias("total")).collect()}
    found = []
    for keys, positions in zip(key_sets, sets):
        # grouping_id has a 1 bit for every column that is aggregated away, first column highest.
        gid = sum(1 << (len(names) - 1 - i) for i in range(len(names)) if f"k{i}" not in positions)
        mine = top.filter(F.col("gid") == gid).select(
            *[F.col(p).alias(f"__hot{i}") for i, p in enumerate(positions)]
        )
        found.append(HotKeys(tuple(keys), mine, totals[gid]) if gid in totals else HotKeys(tuple(keys)))
    return found


@dataclass(frozen=True)
class RowWindow:
    """``measures`` per ``keys`` in ascending ``order``; ``hot`` as in ``over_rows``."""

    keys: Sequence[str]
    order: Sequence[str]
    measures: Sequence[Measure]
    hot: HotKeys | None = None


def over_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    measures: Sequence[Measure],
    hot: HotKeys | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add ``measures`` computed per ``keys`` in ascending ``order``.

    ``order`` should end in columns that make it total; rows equal in all of it are interchangeable.
    ``hot`` comes from ``find_hot``; without it the keys of ``df`` are counted here.
    """
    return over_windows(df, [RowWindow(keys, order, measures, hot)], rows_per_task)


def over_windows(df: DataFrame, windows: Sequence[RowWindow], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Add the measures of all ``windows``, of which none reads what another adds.

    Rows from ``numbered`` are stored already and are not stored again; their number is left out of the result.
    """
    windows = [
        replace(w, hot=find_hot(df, w.keys, rows_per_task=rows_per_task)[0]) if w.hot is None else w for w in windows
    ]
    if all(w.hot.keys is None for w in windows):
        for w in windows:
            df = _within_one_task(df, w.keys, w.order, w.measures)
        return df.drop("__salt")
    # Every window reads the input, so it is stored once, with the number that ties and joins need.
    out = df = df if "__salt" in df.columns else numbered(df, "window-input")
    for w in windows:
        added = _added(df, w, rows_per_task)
        out = out.join(added if len(windows) == 1 else stage(added, "window-added"), "__salt")
    return out.drop("__salt")


def numbered(df: DataFrame, label: str) -> DataFrame:
    """The rows stored, each with a number ``__salt`` of its own."""
    return stage(df.withColumn("__salt", F.monotonically_increasing_id()), label)


def _added(df: DataFrame, w: RowWindow, rows_per_task: int) -> DataFrame:
    """(__salt, measures) of the stored rows; whether the list of hot keys is broadcast follows its size."""
    read = dict.fromkeys(["__salt", *w.keys, *w.order, *[m.column for m in w.measures]])
    slim = df.select(*_quoted(list(read)))
    if w.hot.keys is None:
        done = _within_one_task(slim, w.keys, w.order, w.measures)
    else:
        same = _all(F.col(f"`{k}`").eqNullSafe(F.col(f"__hot{i}")) for i, k in enumerate(w.keys))
        usual = _within_one_task(slim.join(w.hot.keys, same, "left_anti"), w.keys, w.order, w.measures)
        busy = slim.join(w.hot.keys, same, "left_semi")
        done = usual.unionByName(_across_tasks(busy, w.keys, w.order, w.measures, w.hot.total, rows_per_task))
    return done.select("__salt", *[m.name for m in w.measures])


def _all(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _within_one_task(df, keys, order, measures) -> DataFrame:
    ordered = Window.partitionBy(*_quoted(keys)).orderBy(*_quoted(order))
    return df.withColumns(
        {m.name: m.finish(_AGGREGATE[m.how](m.column).over(_rows(ordered, m.frame))) for m in measures}
    )


def _quoted(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{n}`") for n in names]


def _rows(window, frame: RowFrame):
    start = Window.unboundedPreceding if frame.start is None else frame.start
    return window.rowsBetween(start, frame.end)


def with_positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], total: int, rows_per_task: int
) -> DataFrame:
    """Add ``__rn``, the 0-based position of each row within its key, without one task per key.

    The salt is written out before the range exchange and the partition number after it, so both are
    plain stored values from then on and re-run tasks cannot move rows between ranges. Stored rows that have a
    ``__salt`` already are not stored again, and keep it.
    """
    salted = df
    if "__salt" not in df.columns:
        salted = stage(df.withColumn("__salt", F.monotonically_increasing_id()), "busy-rows")
    blocks = max(1, ceil(total / rows_per_block(total, rows_per_task)))
    ranged = stage(
        salted.repartitionByRange(
            blocks, *[c.asc_nulls_first() for c in _quoted([*keys, *order])], F.col("__salt")
        ).withColumn("__block", F.spark_partition_id()),
        "busy-blocks",
    )
    in_order = Window.partitionBy(*_quoted(keys)).orderBy("__block")
    starts = (
        ranged.groupBy(*_quoted(keys), "__block")
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn(
            "__start",
            F.coalesce(F.sum("__n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        )
    )
    here = Window.partitionBy(*_quoted(keys), "__block").orderBy(*_quoted(order), "__salt")
    # One row per block plus at most one more per hot key; the join below the window is on the window's keys.
    return (
        _attach(ranged, starts, [*keys, "__block"], ["__start"])
        .withColumn("__rn", F.col("__start") + F.row_number().over(here) - 1)
        .drop("__start", "__block", *({"__salt"} - set(df.columns)))
    )


def _attach(df: DataFrame, small: DataFrame, on: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Left join of a small per-key frame, treating null keys as equal."""
    renamed = small.select(
        *[F.col(f"`{k}`").alias(f"__on{i}") for i, k in enumerate(on)], *values
    )
    same = _all(F.col(f"`{k}`").eqNullSafe(F.col(f"__on{i}")) for i, k in enumerate(on))
    joined = df.join(renamed, same, "left")
    return joined.drop(*[f"__on{i}" for i in range(len(on))])


def _across_tasks(df, keys, order, measures, total, rows_per_task) -> DataFrame:
    columns = df.columns
    reach = max([-m.frame.start for m in measures if m.frame.start is not None], default=0)
    width = max(rows_per_block(total, rows_per_task), reach)
    ranked = with_positions(df, keys, order, total, rows_per_task).withColumn(
        "__chunk", F.floor(F.col("__rn") / width)
    )
    own = F.struct(F.col("__chunk").alias("__piece"), F.lit(False).alias("__lead_in"))
    ahead = F.struct((F.col("__chunk") + 1).alias("__piece"), F.lit(True).alias("__lead_in"))
    near_end = F.col("__rn") % width >= width - reach
    pieces = ranked.select(
        "*", F.inline(F.when(near_end, F.array(own, ahead)).otherwise(F.array(own)))
    )
    here = Window.partitionBy(*_quoted(keys), "__piece").orderBy("__rn")
    out = {
        m.name: m.finish(_AGGREGATE[m.how](m.column).over(_rows(here, m.frame)))
        for m in measures
        if m.frame.start is not None
    }
    running = [m for m in measures if m.frame.start is None]
    values = list(dict.fromkeys(m.column for m in running))
    if values:
        # One row per chunk of a hot key; joined on the keys that the next window needs anyway.
        pieces = _attach(
            pieces,
            _carried(ranked, keys, values),
            [*keys, "__piece"],
            [f"__{p}{i}" for i in range(len(values)) for p in ("cn", "cs", "cq")],
        )
        out |= {m.name: m.finish(_running(m, values.index(m.column), here)) for m in running}
    done = pieces.withColumns(out).filter(~F.col("__lead_in"))
    return done.select(*[F.col(f"`{c}`") for c in columns], *[m.name for m in measures])


def _carried(ranked: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Count, sum and squared deviations of all earlier chunks of the same key, for every chunk."""
    per_chunk = ranked.groupBy(*_quoted(keys), F.col("__chunk").alias("__piece")).agg(
        *[
            a
            for i, v in enumerate(values)
            for a in (
                F.count(v).alias(f"__n{i}"),
                F.sum(v).alias(f"__s{i}"),
                F.var_pop(v).alias(f"__v{i}"),
            )
        ]
    )
    whole = Window.partitionBy(*_quoted(keys))
    before = whole.orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk
    for i in range(len(values)):
        n, s, v = F.col(f"__n{i}"), F.col(f"__s{i}"), F.col(f"__v{i}")
        centre = F.try_divide(F.sum(s).over(whole), F.sum(n).over(whole))
        carried = carried.withColumn(f"__c{i}", centre)
        around = n * v + n * F.pow(F.try_divide(s, n) - F.col(f"__c{i}"), F.lit(2))
        carried = carried.withColumn(f"__a{i}", around).withColumns(
            {
                f"__cn{i}": F.coalesce(F.sum(n).over(before), F.lit(0)),
                f"__cs{i}": F.sum(s).over(before),
                f"__ca{i}": F.sum(f"__a{i}").over(before),
            }
        )
        # Squared deviations around the key's centre, moved to the mean of the earlier chunks.
        cn, cs = F.col(f"__cn{i}"), F.col(f"__cs{i}")
        shift = F.try_divide(cs, cn) - F.col(f"__c{i}")
        carried = carried.withColumn(f"__cq{i}", F.col(f"__ca{i}") - cn * shift * shift)
    return carried


def _running(m: Measure, i: int, here) -> Column:
    own = F.when(~F.col("__lead_in"), F.col(m.column))
    frame = _rows(here, m.frame)
    n, s = F.count(own).over(frame), F.sum(own).over(frame)
    cn, cs = F.col(f"__cn{i}"), F.col(f"__cs{i}")
    count = F.coalesce(cn, F.lit(0)) + n
    total = F.when(count > 0, F.coalesce(cs, F.lit(0)) + F.coalesce(s, F.lit(0)))
    if m.how == "sum":
        return total
    if m.how == "avg":
        return F.try_divide(total, count)
    between = F.try_divide(s, n) - F.try_divide(cs, cn)
    squares = (
        F.coalesce(F.col(f"__cq{i}"), F.lit(0.0))
        + F.coalesce(F.var_pop(own).over(frame) * n, F.lit(0.0))
        + F.coalesce(between * between * F.try_divide(cn * n, count), F.lit(0.0))
    )
    return F.when(count > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (count - 1)))


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int = 1) -> DataFrame:
    """The last ``n`` rows per key.

    Spark keeps only ``n`` rows per key and task before the shuffle (window group limit), so a hot key
    brings at most ``n`` rows per task to its reducer.
    """
    window = Window.partitionBy(*_quoted(keys)).orderBy(*[c.desc() for c in _quoted(order)])
    ranked = df.withColumn("__latest", F.row_number().over(window))
    return ranked.filter(F.col("__latest") <= n).drop("__latest")


def spread_max(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Give every row of a key the largest non-null value of each column within that key.

    For keys with few rows each, such as the team rows of a game: they are grouped by key, team and
    result beforehand, so the copies and players of a hot game are already one row per team.
    """
    window = Window.partitionBy(*_quoted(keys))
    return df.withColumns({c: F.max(c).over(window) for c in columns})

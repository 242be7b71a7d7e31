"""Row-frame measures loaded by increments: a state per key merges with each load's rows, so history is never reread.

The state has two tables:

- ``totals``: per key and running column, the count, sum and squared deviations around the mean (``n``, ``s``, ``q``)
  of all loaded rows; two states merge by the pairwise formula of Chan, Golub and LeVeque;
- ``tail``: the last ``reach`` rows of each key (``reach``: the longest trailing frame), enough for every trailing
  frame and lag of the next rows.

A load's rows must come after all loaded rows of their key in ``order`` (a day's rows after earlier days). The
tail's rows lead in, the totals are the carry of running frames, and the measures are those of ``windows.over_rows``
over all rows at once: ``tests/test_increments.py`` checks 1, 2 and 10 loads against one pass. Null keys are one key;
null values count as Spark's aggregates count them (not at all); an empty load leaves the state as it was. Each
state is stored, so a load reads only the state and its own rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hoopline.operators.windows import _AGGREGATE, Measure, _all, _attach, _quoted, _rows, _running
from hoopline.session import stage


@dataclass
class RollingState:
    totals: DataFrame | None
    tail: DataFrame | None


def _reach(measures: Sequence[Measure]) -> int:
    return max([-m.frame.start for m in measures if m.frame.start is not None], default=0)


def advance(
    state: RollingState | None, rows: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Sequence[Measure]
) -> tuple[DataFrame, RollingState]:
    """The measures of ``rows`` given everything loaded before (``state``), and the state after them."""
    state = state or RollingState(None, None)
    columns = rows.columns
    running = [m for m in measures if m.frame.start is None]
    values = list(dict.fromkeys(m.column for m in running))
    kept = list(dict.fromkeys([*keys, *order, *(m.column for m in measures)]))
    reach = _reach(measures)

    fresh = rows.withColumn("__lead_in", F.lit(False))
    both = fresh if state.tail is None else fresh.unionByName(
        state.tail.withColumn("__lead_in", F.lit(True)), allowMissingColumns=True
    )
    # Lead-in rows come first; rows of the load follow in ``order``.
    here = Window.partitionBy(*_quoted(keys)).orderBy(F.col("__lead_in").desc(), *[F.col(f"`{c}`") for c in order])
    out = {
        m.name: m.finish(_AGGREGATE[m.how](m.column).over(_rows(here, m.frame)))
        for m in measures
        if m.frame.start is not None
    }
    if values:
        carry = [f"__{p}{i}" for i in range(len(values)) for p in ("cn", "cs", "cq")]
        if state.totals is None:
            both = both.withColumns({c: F.lit(None).cast("long" if c.startswith("__cn") else "double") for c in carry})
        else:
            both = _attach(
                both,
                state.totals.select(
                    *keys, *[F.col(f"{p}{i}").alias(f"__c{p}{i}") for i in range(len(values)) for p in ("n", "s", "q")]
                ),
                keys,
                carry,
            )
        out |= {m.name: m.finish(_running(m, values.index(m.column), here)) for m in running}
    measured = both.withColumns(out).filter(~F.col("__lead_in")).select(
        *[F.col(f"`{c}`") for c in columns], *[m.name for m in measures]
    )

    tail = state.tail
    if reach:
        last = Window.partitionBy(*_quoted(keys)).orderBy(
            F.col("__lead_in").asc(), *[F.col(f"`{c}`").desc() for c in order]
        )
        tail = stage(
            both.withColumn("__back", F.row_number().over(last)).filter(F.col("__back") <= reach).select(*kept),
            "rolling-tail",
        )
    totals = state.totals
    if values:
        totals = stage(_merge_totals(state.totals, rows, keys, values), "rolling-totals")
    return measured, RollingState(totals, tail)


def _merge_totals(old: DataFrame | None, rows: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Count, sum and squared deviations per key of the old state and the new rows together."""
    new = rows.groupBy(*_quoted(keys)).agg(
        *[
            a
            for i, v in enumerate(values)
            for a in (
                F.count(v).alias(f"n{i}"),
                F.sum(F.col(v).cast("double")).alias(f"s{i}"),
                (F.var_pop(v) * F.count(v)).alias(f"q{i}"),
            )
        ]
    )
    if old is None:
        return new
    a = old.select(*[F.col(f"`{k}`").alias(f"__a{j}") for j, k in enumerate(keys)], *[
        F.col(f"{p}{i}").alias(f"a{p}{i}") for i in range(len(values)) for p in ("n", "s", "q")
    ])
    same = _all(F.col(f"`{k}`").eqNullSafe(F.col(f"__a{j}")) for j, k in enumerate(keys))
    joined = new.join(a, same, "full")
    merged = [F.coalesce(F.col(f"`{k}`"), F.col(f"__a{j}")).alias(k) for j, k in enumerate(keys)]
    for i in range(len(values)):
        na, nb = F.coalesce(F.col(f"an{i}"), F.lit(0)), F.coalesce(F.col(f"n{i}"), F.lit(0))
        sa, sb = F.coalesce(F.col(f"as{i}"), F.lit(0.0)), F.coalesce(F.col(f"s{i}"), F.lit(0.0))
        qa, qb = F.coalesce(F.col(f"aq{i}"), F.lit(0.0)), F.coalesce(F.col(f"q{i}"), F.lit(0.0))
        n = na + nb
        shift = F.try_divide(sb, nb) - F.try_divide(sa, na)
        q = qa + qb + F.coalesce(shift * shift * F.try_divide(na * nb, n), F.lit(0.0))
        merged += [n.alias(f"n{i}"), F.when(n > 0, sa + sb).alias(f"s{i}"), F.when(n > 0, q).alias(f"q{i}")]
    # Keys where both sides are null keys fall out of the coalesce as null, which is that key.
    return joined.select(*merged)

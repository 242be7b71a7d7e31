"""Sorted reports, top-k, membership filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sorted_report(
    df: DataFrame, metric: str, ascending: bool = False, allowed: Sequence[str] | None = None
) -> DataFrame:
    """A report ordered by one of its metrics; missing values come last either way."""
    if allowed is not None and metric not in allowed:
        raise ValueError(f"sort by one of {list(allowed)}, not {metric!r}")
    by = F.col(f"`{metric}`")
    first = by.asc_nulls_last() if ascending else by.desc_nulls_last()
    # The other columns make the order total, and let the range exchange split a frequent value.
    return df.orderBy(first, *[F.col(f"`{c}`") for c in df.columns if c != metric])


def sorted_desc(df: DataFrame, *columns: str) -> DataFrame:
    """Descending on ``columns`` in turn; remaining columns break ties for the same reason."""
    rest = [F.col(f"`{c}`").desc() for c in df.columns if c not in columns]
    return df.orderBy(*[F.col(f"`{c}`").desc() for c in columns], *rest)


def top_k(df: DataFrame, score: str, k: int, *ties: str, ascending: bool = False) -> DataFrame:
    """The ``k`` highest (or lowest) rows, kept per task before they meet (TakeOrderedAndProject)."""
    by = F.col(f"`{score}`")
    first = by.asc_nulls_last() if ascending else by.desc_nulls_last()
    return df.orderBy(first, *ties).limit(k)


def members(df: DataFrame, listed: DataFrame, on: str, listed_on: str | None = None) -> DataFrame:
    """Rows whose key occurs in another table."""
    keys = listed.select(F.col(f"`{listed_on or on}`").alias(on)).distinct()
    return df.join(keys, on, "left_semi")


def non_members(df: DataFrame, listed: DataFrame, on: str, listed_on: str | None = None) -> DataFrame:
    """Rows whose key does not occur in another table; nulls in that table exclude nothing."""
    keys = listed.select(F.col(f"`{listed_on or on}`").alias(on)).distinct()
    return df.join(keys, on, "left_anti")


def minimum_history(df: DataFrame, columns: Sequence[str], games: int = 5) -> DataFrame:
    """Rows in which every games-played column reaches ``games``."""
    condition: Column = F.lit(True)
    for c in columns:
        condition = condition & (F.col(c) >= games)
    return df.filter(condition)

"""Column expressions for guarded arithmetic, flags and null handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """``top / bottom``, null where ``bottom`` is 0."""
    return F.try_divide(_col(top), _col(bottom))


def percentage(top: Column | str, bottom: Column | str) -> Column:
    """``ratio`` times 100."""
    return ratio(top, bottom) * 100


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is null."""
    return F.when(condition, 1).otherwise(0)


def total(value: Column | str) -> Column:
    """Sum that is 0 rather than null when every value is missing."""
    return F.coalesce(F.sum(_col(value)), F.lit(0))


def drop_null_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any of ``subset``."""
    return df.dropna("any", subset=list(subset) if subset else None)


def fill_with_means(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace nulls in each column by the column's mean.

    The means are fitted here in one aggregation; one row with a number per column comes back. A
    column without any value has no mean and stays null.
    """
    typed = df.withColumns({c: F.col(c).cast("double") for c in columns})
    row = typed.agg(*[F.avg(c).alias(c) for c in columns]).first()
    return typed.fillna({c: row[c] for c in columns if row[c] is not None})


def two_point_columns(df: DataFrame) -> DataFrame:
    """Two-point makes and attempts from the field-goal and three-point columns."""
    return df.withColumns(
        {"fg2m": F.col("fgm") - F.col("fg3m"), "fg2a": F.col("fga") - F.col("fg3a")}
    )


def stamp(df: DataFrame, **constants: object) -> DataFrame:
    """Add constant columns such as season or period."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def second_night(last_dates: Iterable[Column | str], as_of: Column) -> Column:
    """1 when any of the last-game dates is the day before ``as_of``."""
    yesterday = F.date_sub(as_of, 1)
    hit = F.lit(False)
    for d in last_dates:
        hit = hit | (_col(d).cast("date") == yesterday)
    return flag(hit)

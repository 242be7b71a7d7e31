"""Incremental loading rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.functions.text import strip_zeros

# Fixed value: the first season to load when nothing has been loaded.
START_SEASON = 1979


def next_load_date(df: DataFrame, column: str) -> DataFrame:
    """One row: the day after the latest loaded date, as a date and as MM/DD/YYYY."""
    mark = F.date_add(F.max(column), 1)
    return df.agg(mark.alias("next_date"), F.date_format(mark, "MM/dd/yyyy").alias("next_date_text"))


def since_mark(df: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Rows dated after everything in ``target``; all rows when it is empty."""
    mark = target.agg(F.max(target_column)).scalar()
    return df.filter(mark.isNull() | (F.col(column) > mark))


def latest_season(df: DataFrame, column: str, start: int = START_SEASON) -> DataFrame:
    """One row: the latest loaded season, or ``start`` when there is none."""
    return df.agg(F.coalesce(F.max(column), F.lit(start)).alias("season"))


def new_keys(
    source: DataFrame, target: DataFrame | None, key: str, target_key: str | None = None, normalise=strip_zeros
) -> DataFrame:
    """Distinct source rows whose normalised key is not in the target; all when there is no target."""
    wanted = source.withColumn(key, normalise(key)).distinct()
    if target is None:
        return wanted
    present = target.select(normalise(target_key or key).alias(key)).distinct()
    return wanted.join(present, key, "left_anti")


def season_filter(season: Column | str, first: int) -> Column:
    """Seasons from ``first`` on."""
    return (F.col(season) if isinstance(season, str) else season) >= first


def season_id_filter(season_id: Column | str, first: int = 21996) -> Column:
    """Whole-id comparison: the leading digit (kind of game) counts, not just the year."""
    value = F.col(season_id) if isinstance(season_id, str) else season_id
    return value.try_cast("int") >= first

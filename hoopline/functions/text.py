"""Column expressions that clean text: ids, dates, matchups, heights, lists."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def matchup_team(matchup: Column | str) -> Column:
    """First word of a matchup such as ``AAA @ BBB``."""
    return F.split(F.trim(_col(matchup)), r"\s+")[0]


def matchup_opponent(matchup: Column | str) -> Column:
    """Last word of a matchup."""
    return F.element_at(F.split(F.trim(_col(matchup)), r"\s+"), -1)


def matchup_side(matchup: Column | str) -> Column:
    """``AWAY`` when the second word is ``@``, else ``HOME``."""
    second = F.get(F.split(F.trim(_col(matchup)), r"\s+"), F.lit(1))
    return F.when(second == "@", "AWAY").otherwise("HOME")


def with_matchup(df: DataFrame, matchup: str = "MATCHUP") -> DataFrame:
    """Add TEAM, OPPONENT and HOME/AWAY from the matchup text."""
    return df.withColumns(
        {
            "TEAM": matchup_team(matchup),
            "OPPONENT": matchup_opponent(matchup),
            "HOME/AWAY": matchup_side(matchup),
        }
    )


def iso_date(text: Column | str) -> Column:
    """``YYYY-MM-DD`` text to a date; null when it does not parse."""
    return F.try_to_date(_col(text), "yyyy-MM-dd")


def mixed_date(text: Column | str) -> Column:
    """Dates written ``APR 9, 2023`` or ``2023-04-09``, the latter with or without a time after it.

    A failed parse raises and drops an exception inside Spark, which costs more than the rest of the row, so each
    format only meets texts of its shape: a digit first cannot be a month's name, and only a day that was found is read.
    """
    value = F.trim(_col(text))
    day = F.regexp_extract(value, r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})(?:[T ].*)?$", 1)
    numeric = F.substring(value, 1, 1).between("0", "9")
    return F.coalesce(
        F.when(~numeric, F.try_to_date(F.initcap(value), "MMM d, yyyy")),
        F.when(day != "", F.try_to_date(day, "yyyy-M-d")),
    )


def season_year(season_id: Column | str) -> Column:
    """The last four characters of a season id as a number."""
    return F.right(_col(season_id), F.lit(4)).try_cast("int")


def height_inches(height: Column | str) -> Column:
    """``F-I`` (feet, inches) to inches; null for a blank or malformed height."""
    value = _col(height)
    feet = F.split_part(value, F.lit("-"), F.lit(1)).try_cast("double")
    inches = F.split_part(value, F.lit("-"), F.lit(2)).try_cast("double")
    return feet * 12 + inches


def strip_zeros(value: Column | str) -> Column:
    """An id without its leading zeros."""
    return F.ltrim(_col(value).cast("string"), F.lit("0"))


def id_list(text: Column | str) -> Column:
    """``-1-2-3-`` to an array of ids."""
    return F.split(F.btrim(_col(text), F.lit("-")), "-")


def blank_to_null(df: DataFrame, whitespace: bool = False) -> DataFrame:
    """Empty strings become null; with ``whitespace`` also strings of blanks only."""
    out = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.StringType):
            empty = value.rlike(r"^\s*$") if whitespace else value == ""
            value = F.when(~empty, value).alias(field.name)
        out.append(value)
    return df.select(*out)


def draft_number(value: Column | str) -> Column:
    """Draft fields as numbers; ``Undrafted`` and missing values are 0."""
    text = _col(value).cast("string")
    return F.when(text == "Undrafted", F.lit(0)).otherwise(F.coalesce(text.try_cast("int"), F.lit(0)))


def snake_case(name: str) -> str:
    """camelCase to snake_case."""
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """All columns renamed to snake_case; changes metadata only."""
    return df.withColumnsRenamed({name: snake_case(name) for name in df.columns})


def drop_ranks(df: DataFrame) -> DataFrame:
    """Drop columns with RANK in their name and lower-case the others."""
    return df.select(*[F.col(f"`{c}`").alias(c.lower()) for c in df.columns if "RANK" not in c])


def rename(df: DataFrame, names: dict[str, str], prefix: str = "") -> DataFrame:
    """Rename by a map, then put ``prefix`` before every column."""
    return df.select(*[F.col(f"`{c}`").alias(prefix + names.get(c, c)) for c in df.columns])

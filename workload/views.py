"""The test tables seen as logs, players, lines and box scores (columns as the library expects).

Every order is a game: the customer's nation plays at home, another nation away, and each line item
is one player's game, on the home side when its line number is odd.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that order one player's rows on one date in the test data.
TIES = ["Game_ID", "LINE_NO", "PTS"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _code(nation: Column) -> Column:
    return F.concat(F.lit("T"), F.lpad(nation.cast("string"), 2, "0"))


def _game_id(key: Column) -> Column:
    return F.lpad(key.cast("string"), 10, "0")


def _played(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with their game's date and teams.

    Orders meet their customers before the line items, which are dealt once, by order, as the sums per game need them.
    """
    away = (F.col("c_nationkey") + 1 + F.col("l_orderkey") % 24) % 25
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    hosted = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    return (
        table(spark, sf, "lineitem")
        .join(hosted, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumns(
            {
                "game_date": F.col("o_orderdate").cast("date"),
                "at_home": F.col("l_linenumber") % 2 == 1,
                "home_id": F.col("c_nationkey").cast("bigint"),
                "away_id": away.cast("bigint"),
            }
        )
    )


def player_logs(spark: SparkSession, sf: str) -> DataFrame:
    p = _played(spark, sf)
    home, away, at_home = _code(F.col("home_id")), _code(F.col("away_id")), F.col("at_home")
    home_wins = F.col("l_orderkey") % 2 == 0
    return p.select(
        F.concat(F.lit("2"), F.year("game_date").cast("string")).alias("SEASON_ID"),
        F.col("l_suppkey").alias("Player_ID"),
        _game_id(F.col("l_orderkey")).alias("Game_ID"),
        F.col("game_date").alias("GAME_DATE"),
        F.when(F.col("l_orderkey") % 97 != 0, F.when(home_wins == at_home, "W").otherwise("L")).alias("WL"),
        F.col("l_quantity").alias("PTS"),
        F.when(at_home, home).otherwise(away).alias("TEAM"),
        F.when(at_home, away).otherwise(home).alias("OPPONENT"),
        F.when(at_home, "HOME").otherwise("AWAY").alias("HOME/AWAY"),
        F.concat(F.lit("Player "), F.col("l_suppkey").cast("string")).alias("player_name"),
        F.col("l_linenumber").alias("LINE_NO"),
    )


def players(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s_suppkey")
    height = F.concat((5 + s % 3).cast("string"), F.lit("-"), (s % 12).cast("string"))
    return table(spark, sf, "supplier").select(
        s.alias("PERSON_ID"),
        F.col("s_name").alias("DISPLAY_FIRST_LAST"),
        F.when(s % 50 == 7, "").otherwise(height).alias("HEIGHT"),
        F.col("s_nationkey").cast("bigint").alias("TEAM_ID"),
        (1995 + s % 4).cast("int").alias("FROM_YEAR"),
        (1995 + s % 4 + s % 3).cast("int").alias("TO_YEAR"),
        F.when(s % 5 == 0, "Undrafted").otherwise((1985 + s % 9).cast("string")).alias("DRAFT_YEAR"),
        F.when(s % 5 != 0, (1 + s % 2).cast("string")).alias("DRAFT_ROUND"),
        F.when(s % 5 != 0, (1 + s % 60).cast("string")).alias("DRAFT_NUMBER"),
    )


def _box_measures() -> dict[str, Column]:
    """Box-score statistics of one side as whole-number sums over its line items."""
    line, part, supp, qty = (F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))
    return {
        "n": F.lit(1),
        "pts": qty,
        "fgm": line,
        "fga": line + 2,
        "fg3m": F.when(F.col("l_returnflag") == "R", 1).otherwise(0),
        "fg3a": F.when(F.col("l_returnflag") == "A", 1).otherwise(2),
        "ftm": F.when(F.col("l_linestatus") == "F", 1).otherwise(0),
        "fta": F.when(part % 3 == 0, 2).otherwise(1),
        "oreb": part % 5,
        "dreb": part % 7,
        "ast": supp % 6,
        "stl": supp % 4,
        "blk": supp % 3,
        "tov": part % 4,
        "pf": part % 6,
        "off_turnovers": F.when(supp % 2 == 0, qty).otherwise(0),
        "second_chance": F.when(part % 5 == 0, qty).otherwise(0),
        "fast_break": F.when(part % 3 == 0, qty).otherwise(0),
        "paint": F.when(part % 2 == 0, qty).otherwise(0),
        "cents": F.round(F.col("l_discount") * 100).cast("int"),
    }


def games(spark: SparkSession, sf: str) -> DataFrame:
    """One row per game with the box-score sums of each side as ``home_*`` and ``away_*``."""
    sides = {"home": F.col("at_home"), "away": ~F.col("at_home")}
    sums = [
        F.sum(F.when(here, value).otherwise(0)).alias(f"{side}_{name}")
        for side, here in sides.items()
        for name, value in _box_measures().items()
    ]
    return (
        _played(spark, sf)
        .groupBy("l_orderkey", "game_date", "home_id", "away_id")
        .agg(*sums)
        .withColumnsRenamed({"l_orderkey": "game_key"})
        .withColumn("season", F.year("game_date"))
    )


def raw_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines as landed: without the underdog column."""
    g = games(spark, sf)
    home, away = F.col("home_pts"), F.col("away_pts")
    home_favored = F.col("game_key") % 3 != 0
    margin = F.when(home_favored, home - away).otherwise(away - home)
    spread = (F.col("game_key") % 15).cast("double") + 0.5
    return g.select(
        _game_id(F.col("game_key")).alias("game_id"),
        F.col("game_date").cast("string").alias("game_date"),
        _code(F.col("home_id")).alias("home_team_abbrev"),
        _code(F.col("away_id")).alias("visit_team_abbrev"),
        F.when(home_favored, _code(F.col("home_id"))).otherwise(_code(F.col("away_id"))).alias("favorite"),
        F.when(home_favored, -spread).otherwise(spread).alias("line"),
        spread.alias("spread"),
        F.lit(100.0).alias("game_over_under"),
        (home + away).alias("total"),
        home.alias("home_team_score"),
        away.alias("visit_team_score"),
        F.when(margin > spread, 1).otherwise(0).alias("favorite_covered"),
        F.when(margin > spread, 0).otherwise(1).alias("underdog_covered"),
        F.when(home + away > 100, 1).otherwise(0).alias("over_hit"),
        F.when(home + away > 100, 0).otherwise(1).alias("under_hit"),
    )


def lines(spark: SparkSession, sf: str) -> DataFrame:
    from hoopline.plans.lines import with_underdog

    return with_underdog(raw_lines(spark, sf))


def team_logs(spark: SparkSession, sf: str, g: DataFrame | None = None) -> DataFrame:
    """Two rows per game, one per side that has any line items; ``g`` is a stored ``games``."""
    g = games(spark, sf) if g is None else g
    home_wins = F.col("game_key") % 2 == 0

    def side(me: str, other: str, wins: Column) -> Column:
        s = lambda name: F.col(f"{me}_{name}").cast("double")
        return F.struct(
            F.col(f"{me}_id").alias("TEAM_ID"),
            _code(F.col(f"{me}_id")).alias("TEAM_ABBREVIATION"),
            F.concat(F.lit("Team "), F.col(f"{me}_id").cast("string")).alias("TEAM_NAME"),
            F.concat(
                _code(F.col(f"{me}_id")),
                F.lit(" vs. " if me == "home" else " @ "),
                _code(F.col(f"{other}_id")),
            ).alias("MATCHUP"),
            F.when(wins, "W").otherwise("L").alias("WL"),
            (240 + 5 * (F.col("game_key") % 3)).cast("double").alias("MIN"),
            s("fgm").alias("FGM"),
            s("fga").alias("FGA"),
            F.try_divide(s("fgm"), s("fga")).alias("FG_PCT"),
            s("fg3m").alias("FG3M"),
            s("fg3a").alias("FG3A"),
            F.try_divide(s("fg3m"), s("fg3a")).alias("FG3_PCT"),
            s("ftm").alias("FTM"),
            s("fta").alias("FTA"),
            F.try_divide(s("ftm"), s("fta")).alias("FT_PCT"),
            s("oreb").alias("OREB"),
            s("dreb").alias("DREB"),
            (s("oreb") + s("dreb")).alias("REB"),
            s("ast").alias("AST"),
            s("stl").alias("STL"),
            s("blk").alias("BLK"),
            s("tov").alias("TOV"),
            s("pf").alias("PF"),
            s("pts").alias("PTS"),
            (s("pts") - F.col(f"{other}_pts")).alias("PLUS_MINUS"),
            F.col(f"{me}_n").alias("n"),
            _code(F.col(f"{me}_id")).alias("TEAM"),
            _code(F.col(f"{other}_id")).alias("OPPONENT"),
            F.lit(me.upper()).alias("HOME/AWAY"),
        )

    played = F.filter(
        F.array(
            F.when(F.col("home_n") > 0, side("home", "away", home_wins)),
            F.when(F.col("away_n") > 0, side("away", "home", ~home_wins)),
        ),
        lambda x: x.isNotNull(),
    )
    return g.select(
        _game_id(F.col("game_key")).alias("GAME_ID"),
        F.col("game_date").alias("GAME_DATE"),
        F.col("season").alias("SEASON_YEAR"),
        F.inline(played),
    ).drop("n")


def _wide_header() -> list[Column]:
    return [
        # Ids without leading zeros, as a feed that dropped them would land.
        F.col("game_key").cast("string").alias("game_id"),
        F.col("game_date").alias("date"),
        F.col("season"),
        F.col("home_id").alias("home_team_id"),
        F.col("away_id").alias("away_team_id"),
    ]


def team_misc(spark: SparkSession, sf: str, g: DataFrame | None = None) -> DataFrame:
    stats = ["off_turnovers", "second_chance", "fast_break", "paint"]
    other = {"home": "away", "away": "home"}
    g = games(spark, sf) if g is None else g
    return g.select(
        *_wide_header(),
        *[
            c
            for side in other
            for s in stats
            for c in (
                F.col(f"{side}_{s}").alias(f"{side}_points_{s}"),
                F.col(f"{other[side]}_{s}").alias(f"{side}_opp_points_{s}"),
            )
        ],
    )


def team_advanced(spark: SparkSession, sf: str, g: DataFrame | None = None) -> DataFrame:
    g = games(spark, sf) if g is None else g
    return g.select(
        *_wide_header(),
        *[
            c
            for side in ("home", "away")
            for c in (
                F.try_divide(f"{side}_ast", f"{side}_tov").alias(f"{side}_assist_to_turnover"),
                (90 + F.col(f"{side}_cents") / 10).alias(f"{side}_pace"),
            )
        ],
    )

"""Team box scores with miscellaneous and advanced metrics: the feature table of the win study."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.functions.numeric import fill_with_means, flag, two_point_columns
from hoopline.functions.text import strip_zeros
from hoopline.operators.ingest import season_filter
from hoopline.session import stage

# Feature lists of the script form (28) and the notebook form (24) of the study.
SCRIPT_FEATURES = [
    "min", "fgm", "fga", "fg_pct", "fg3m", "fg3a", "fg3_pct", "ftm", "fta", "ft_pct", "oreb", "dreb",
    "reb", "ast", "stl", "blk", "tov", "pf", "pts_off_turnovers", "second_chance_pts", "fast_break_pts",
    "paint_pts", "opp_pts_off_turnovers", "opp_second_chance_pts", "opp_fast_break_pts", "opp_paint_pts",
    "assist_to_turnover", "pace",
]
NOTEBOOK_FEATURES = [
    "fg2m", "fg2a", "fg3m", "fg3a", "ftm", "fta", "ft_pct", "oreb", "dreb", "ast", "stl", "blk", "tov",
    "pf", "pts_off_turnovers", "second_chance_pts", "fast_break_pts", "paint_pts",
    "opp_pts_off_turnovers", "opp_second_chance_pts", "opp_fast_break_pts", "opp_paint_pts",
    "assist_to_turnover", "pace",
]
# Metric columns per side, by the name they get.
MISC_METRICS = {
    "pts_off_turnovers": "points_off_turnovers",
    "second_chance_pts": "points_second_chance",
    "fast_break_pts": "points_fast_break",
    "paint_pts": "points_paint",
    "opp_pts_off_turnovers": "opp_points_off_turnovers",
    "opp_second_chance_pts": "opp_points_second_chance",
    "opp_fast_break_pts": "opp_points_fast_break",
    "opp_paint_pts": "opp_points_paint",
}
ADVANCED_METRICS = {"assist_to_turnover": "assist_to_turnover", "pace": "pace"}


def side_rows(wide: DataFrame, metrics: dict[str, str], since: int) -> DataFrame:
    """Wide game rows to distinct team rows, both sides from one scan.

    Rows are dealt by game and team, which serves both the removal of copies and the joins on these keys.
    """

    def side(me: str) -> Column:
        return F.struct(
            F.col(f"{me}_team_id").alias("team_id"),
            *[F.col(f"{me}_{source}").alias(name) for name, source in metrics.items()],
        )

    return (
        wide.filter(season_filter("season", since))
        .select(
            strip_zeros("game_id").alias("game_id"), "date", F.inline(F.array(side("away"), side("home")))
        )
        .repartition("game_id", "team_id")
        .distinct()
    )


# The statistics of a team's box score, by their names in the team log.
BOX_COLUMNS = [
    "MIN", "FGM", "FGA", "FG_PCT", "FG3M", "FG3A", "FG3_PCT", "FTM", "FTA", "FT_PCT", "OREB",
    "DREB", "REB", "AST", "STL", "BLK", "TOV", "PF",
]


def team_boxscore_features(
    logs: DataFrame, misc: DataFrame, advanced: DataFrame, since: int = 2014
) -> DataFrame:
    """One row per team and game with box score, misc and advanced metrics and the win flag.

    Game ids are compared without leading zeros. All three inputs meet on (game_id, team_id), so the
    second join reuses the partitioning of the first.
    """
    keys = ["game_id", "team_id"]
    traditional = logs.filter(season_filter("SEASON_YEAR", since)).select(
        strip_zeros("GAME_ID").alias("game_id"),
        F.col("TEAM_ID").alias("team_id"),
        F.col("SEASON_YEAR").alias("season"),
        F.col("TEAM").alias("team"),
        F.col("OPPONENT").alias("opp"),
        flag(F.col("WL") == "W").alias("win?"),
        *[F.col(c).alias(c.lower()) for c in BOX_COLUMNS],
    )
    joined = traditional.join(side_rows(misc, MISC_METRICS, since), keys, "inner").join(
        side_rows(advanced, ADVANCED_METRICS, since).drop("date"), keys, "inner"
    )
    return joined.select(
        "game_id", "season", "date", "team", "opp", "win?", *[c.lower() for c in BOX_COLUMNS],
        *MISC_METRICS, *ADVANCED_METRICS,
    )


def feature_matrix(boxscores: DataFrame, features: list[str], label: str = "win") -> DataFrame:
    """Features with missing values filled by their means, the label, and the row's game and team.

    The rows are stored before the means are fitted, so the box scores are joined once, not for the means and again.
    """
    wide = two_point_columns(boxscores).withColumn(label, F.col("`win?`").cast("int"))
    return fill_with_means(stage(wide.select("game_id", "team", label, *features), "matrix"), features)

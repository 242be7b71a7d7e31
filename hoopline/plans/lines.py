"""Betting lines: preparation, coverage reports, over/under reports, today's lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.functions.numeric import drop_null_rows, percentage, total
from hoopline.operators.selection import sorted_report
from hoopline.sources.tables import write_csv

# The metrics each report may be sorted by.
REPORT_METRICS = {
    "coverage": ["fav_hit_percentage", "dog_hit_percentage", "overall_hit_percentage"],
    "favorites": ["hit_percentage_as_favorite_away", "hit_percentage_as_favorite_home"],
    "underdogs": ["hit_percentage_as_underdog_away", "hit_percentage_as_underdog_home"],
    "over_under": ["over_hit_home_percentage", "over_hit_away_percentage"],
}


def with_underdog(lines: DataFrame) -> DataFrame:
    """Add the side that is not the favourite."""
    home, visit = F.col("home_team_abbrev"), F.col("visit_team_abbrev")
    return lines.withColumn("underdog", F.when(F.col("favorite") == home, visit).otherwise(home))


def role_counts(lines: DataFrame, role: str) -> DataFrame:
    """Covers, games and hit percentage of each team as ``favorite`` or ``underdog``."""
    return (
        lines.filter(F.col(role).isNotNull())
        .groupBy(F.col(role).alias("team"))
        .agg(total(f"{role}_covered").alias("covered"), F.count(F.lit(1)).alias("games"))
        .withColumn("hit_percentage", percentage("covered", "games"))
    )


def coverage_summary(lines: DataFrame) -> DataFrame:
    """Favourite, underdog and overall hit rates of teams that have been both.

    Both roles are unpivoted from one scan and aggregated in one shuffle; requiring a game in each
    role is what joining two per-role tables would do.
    """
    roles = F.array(
        *[
            F.struct(
                F.col(role).alias("team"),
                F.lit(role).alias("role"),
                F.col(f"{role}_covered").alias("covered"),
            )
            for role in ("favorite", "underdog")
        ]
    )
    sides = lines.select(F.inline(roles)).filter(F.col("team").isNotNull())
    favorite, underdog = F.col("role") == "favorite", F.col("role") == "underdog"
    counts = (
        sides.groupBy("team")
        .agg(
            total(F.when(favorite, F.col("covered"))).alias("covered_as_favorite"),
            F.count(F.when(favorite, 1)).alias("total_times_favorite"),
            total(F.when(underdog, F.col("covered"))).alias("covered_as_dog"),
            F.count(F.when(underdog, 1)).alias("total_times_underdog"),
        )
        .filter((F.col("total_times_favorite") > 0) & (F.col("total_times_underdog") > 0))
    )
    covered = F.col("covered_as_favorite") + F.col("covered_as_dog")
    games = F.col("total_times_favorite") + F.col("total_times_underdog")
    summary = counts.select(
        "team",
        "covered_as_favorite",
        "total_times_favorite",
        percentage("covered_as_favorite", "total_times_favorite").alias("fav_hit_percentage"),
        "covered_as_dog",
        "total_times_underdog",
        percentage("covered_as_dog", "total_times_underdog").alias("dog_hit_percentage"),
        percentage(covered, games).alias("overall_hit_percentage"),
    )
    return sorted_report(summary, "overall_hit_percentage")


def coverage_splits(lines: DataFrame, role: str) -> DataFrame:
    """Hit rates of a role at home and away, for teams that have had the role in both places."""
    places = {"away": F.col("visit_team_abbrev"), "home": F.col("home_team_abbrev")}
    team, covered = F.col(role), F.col(f"{role}_covered")
    counts = lines.groupBy(team.alias("team")).agg(
        *[
            a
            for place, abbrev in places.items()
            for a in (
                total(F.when(team == abbrev, covered)).alias(f"covered_as_{role}_{place}"),
                F.count(F.when(team == abbrev, 1)).alias(f"total_times_{role}_{place}"),
            )
        ]
    )
    both = counts.filter(
        (F.col(f"total_times_{role}_away") > 0) & (F.col(f"total_times_{role}_home") > 0)
    )
    split = both.select(
        "team",
        *[
            c
            for place in places
            for c in (
                F.col(f"covered_as_{role}_{place}"),
                F.col(f"total_times_{role}_{place}"),
                percentage(f"covered_as_{role}_{place}", f"total_times_{role}_{place}").alias(
                    f"hit_percentage_as_{role}_{place}"
                ),
            )
        ],
    )
    return sorted_report(split, f"hit_percentage_as_{role}_away")


def over_under_splits(lines: DataFrame) -> DataFrame:
    """Scoring and over rates by team at home and away; the over rates are means from 0 to 1."""

    def side(place: str, own: str, opponent: str) -> Column:
        return F.struct(
            F.col(f"{own}_team_abbrev").alias("team"),
            F.lit(place).alias("place"),
            F.col(f"{own}_team_score").alias("score"),
            F.col(f"{opponent}_team_score").alias("opp_score"),
            F.col("over_hit").alias("over_hit"),
        )

    sides = lines.select(
        F.inline(F.array(side("home", "home", "visit"), side("away", "visit", "home")))
    ).filter(F.col("team").isNotNull())

    def at(place: str, column: str) -> Column:
        return F.when(F.col("place") == place, F.col(column))

    counts = sides.groupBy("team").agg(
        *[
            a
            for place in ("home", "away")
            for a in (
                F.avg(at(place, "score")).alias(f"ppg_{place}"),
                F.avg(at(place, "opp_score")).alias(f"opp_ppg_{place}"),
                total(at(place, "over_hit")).alias(f"over_hit_{place}"),
                F.avg(at(place, "over_hit")).alias(f"over_hit_{place}_percentage"),
                F.count(at(place, "place")).alias(f"games_{place}"),
            )
        ]
    )
    both = counts.filter((F.col("games_home") > 0) & (F.col("games_away") > 0))
    scoring = [
        c
        for place in ("home", "away")
        for c in (
            F.col(f"ppg_{place}"),
            F.col(f"opp_ppg_{place}"),
            (F.col(f"ppg_{place}") + F.col(f"opp_ppg_{place}")).alias(f"combined_ppg_{place}"),
        )
    ]
    overs = [
        F.col(c)
        for place in ("home", "away")
        for c in (f"over_hit_{place}", f"over_hit_{place}_percentage")
    ]
    return both.select("team", *scoring, *overs)


def coverage_by_side(lines: DataFrame, teams: DataFrame | None = None) -> DataFrame:
    """Spread statistics by team, place, role and result, with a one-deviation bound.

    Every game is turned into its one or two team rows, so one grouped query covers all teams.
    ``teams`` (column ``team``) restricts the report to listed teams.
    """
    visit, home = F.col("visit_team_abbrev"), F.col("home_team_abbrev")
    places = F.array(
        F.struct(visit.alias("team"), F.lit("away").alias("home_away")),
        F.struct(home.alias("team"), F.lit("home").alias("home_away")),
    )
    rows = lines.select("favorite", "underdog", "favorite_covered", "spread", visit, F.inline(places))
    # A team listed on both sides of one game counts once, as the visitor.
    rows = rows.filter((F.col("home_away") == "away") | ~F.col("team").eqNullSafe(visit))
    rows = rows.filter((F.col("favorite") == F.col("team")) | (F.col("underdog") == F.col("team")))
    if teams is not None:
        rows = rows.join(teams.select("team").distinct(), "team", "left_semi")
    is_favorite = F.col("favorite").eqNullSafe(F.col("team"))
    covered = F.when(is_favorite, F.col("favorite_covered") == 1).otherwise(
        F.col("favorite_covered") == 0
    )
    grouped = (
        rows.withColumns(
            {
                "fav_dog": F.when(is_favorite, "favorite").otherwise("underdog"),
                "result": F.when(covered, "covered").otherwise("failed"),
            }
        )
        .groupBy("team", "home_away", "fav_dog", "result")
        .agg(
            F.round(F.avg("spread"), 2).alias("average_spread"),
            F.round(F.stddev_samp("spread"), 2).alias("std_spread"),
            F.count(F.lit(1)).alias("total_games"),
        )
    )
    mean, deviation = F.col("average_spread"), F.col("std_spread")
    bound = F.when(F.col("fav_dog") == "underdog", mean - deviation).otherwise(mean + deviation)
    return grouped.withColumn("1_std_away", bound).orderBy("team", F.desc("home_away"), "fav_dog", "result")


def todays_lines(raw: DataFrame) -> DataFrame:
    """One row per game of today's per-side lines, with the line signed from the home side."""
    at_home, at_away = F.col("homeAway") == "home", F.col("homeAway") == "away"
    own, opponent = F.col("abbr"), F.col("oppAbbr")
    spread = F.col("hardrock_spread").cast("double")
    return (
        drop_null_rows(raw, ["hardrock_spread"])
        .select(
            "gameID",
            "gameDate",
            F.when(at_home, own).when(at_away, opponent).alias("homeTeam"),
            F.when(at_away, own).when(at_home, opponent).alias("awayTeam"),
            F.col("hardrock_ou").alias("OVER_UNDER"),
            F.when(at_away, -spread).otherwise(spread).alias("LINE"),
        )
        .dropDuplicates()
    )


class LineReports:
    """All reports over one lines table, as lazy frames."""

    def __init__(self, historical: DataFrame, today: DataFrame):
        self.raw = historical
        self.coverage_summary = coverage_summary(historical)
        self.favorite_split = coverage_splits(historical, "favorite")
        self.underdog_split = coverage_splits(historical, "underdog")
        self.over_under_splits = over_under_splits(historical)
        self.todays_lines = drop_null_rows(today)

    def sorted(self, report: str, metric: str, ascending: bool = False) -> DataFrame:
        """A report by name (see REPORT_METRICS), ordered by one of its metrics."""
        frames = {
            "coverage": self.coverage_summary,
            "favorites": self.favorite_split,
            "underdogs": self.underdog_split,
            "over_under": self.over_under_splits,
        }
        return sorted_report(frames[report], metric, ascending, REPORT_METRICS[report])

    def export(self, folder: str) -> None:
        """Every report as CSV below ``folder``; the coverage report is ordered by team."""
        write_csv(self.coverage_summary.orderBy("team"), f"{folder}/coverage")
        write_csv(self.underdog_split, f"{folder}/underdog_split")
        write_csv(self.favorite_split, f"{folder}/favorite_split")
        write_csv(self.over_under_splits, f"{folder}/over_under_splits")
        write_csv(coverage_by_side(self.raw), f"{folder}/coverage_by_side")
        write_csv(self.todays_lines, f"{folder}/todays_lines")

"""Landed payloads to stored tables, incrementally.

Payload frames have one row per landed document: the JSON text plus whatever the landing step knows
about it (season, period, game date). Each job is shape -> keep what is new -> align -> write.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoopline.functions import text
from hoopline.operators.diff import snapshot_diff, status_counts
from hoopline.session import stage
from hoopline.operators.ingest import new_keys, season_id_filter, since_mark
from hoopline.operators.joins import join_renamed, lookup_name
from hoopline.operators.selection import members
from hoopline.sources.payloads import (
    Landed,
    read_landed,
    explode_player_boxscore,
    flatten_result_set,
    flatten_team_boxscore,
)
from hoopline.sources.tables import (
    align_to,
    read_table,
    reload_partition,
    table_exists,
    table_path,
    write_table,
)

# Columns of the play-by-play feed, as typed here.
PLAY_COLUMNS = T.StructType(
    [
        T.StructField("gameId", T.StringType()),
        T.StructField("actionNumber", T.IntegerType()),
        T.StructField("clock", T.StringType()),
        T.StructField("period", T.IntegerType()),
        T.StructField("teamId", T.LongType()),
        T.StructField("teamTricode", T.StringType()),
        T.StructField("personId", T.LongType()),
        T.StructField("playerName", T.StringType()),
        T.StructField("playerNameI", T.StringType()),
        T.StructField("xLegacy", T.IntegerType()),
        T.StructField("yLegacy", T.IntegerType()),
        T.StructField("shotDistance", T.IntegerType()),
        T.StructField("shotResult", T.StringType()),
        T.StructField("isFieldGoal", T.IntegerType()),
        T.StructField("scoreHome", T.StringType()),
        T.StructField("scoreAway", T.StringType()),
        T.StructField("pointsTotal", T.IntegerType()),
        T.StructField("location", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("actionType", T.StringType()),
        T.StructField("subType", T.StringType()),
        T.StructField("shotValue", T.IntegerType()),
        T.StructField("actionId", T.IntegerType()),
    ]
)
# Columns of a championship record.
CHAMPION_COLUMNS = T.StructType(
    [T.StructField("YEARAWARDED", T.IntegerType()), T.StructField("OPPOSITETEAM", T.StringType())]
)


def stored(spark: SparkSession, root: str, schema: str, table: str) -> DataFrame | None:
    """The stored table, or None before its first load."""
    return read_table(spark, root, schema, table) if table_exists(spark, root, schema, table) else None


def shape_player_logs(payloads: DataFrame, columns: T.StructType, active: DataFrame) -> DataFrame:
    """Player-game rows of active players, with parsed matchup and dates, without repeats.

    ``columns`` describes the payload (GAME_DATE and MATCHUP as text); ``active`` has id and full_name.
    """
    rows = text.with_matchup(flatten_result_set(payloads, "payload", columns))
    dated = rows.withColumn("GAME_DATE", text.mixed_date("GAME_DATE"))
    names = active.select("id", "full_name")
    return (
        join_renamed(dated, names, "Player_ID", "id", ["id"])
        .withColumnRenamed("full_name", "player_name")
        .dropDuplicates()
    )


def shape_all_player_logs(payloads: DataFrame, columns: T.StructType, players: DataFrame) -> DataFrame:
    """First full load: like ``shape_player_logs``, but keeps players that are not listed, unnamed."""
    rows = text.with_matchup(flatten_result_set(payloads, "payload", columns))
    dated = rows.withColumn("GAME_DATE", text.mixed_date("GAME_DATE")).drop("MATCHUP", "VIDEO_AVAILABLE")
    return lookup_name(dated, players, "Player_ID", "PERSON_ID", "DISPLAY_FIRST_LAST", "player_name")


def ingest_player_logs(
    payloads: DataFrame, columns: T.StructType, active: DataFrame, target: T.StructType, root: str
) -> str:
    """Append player logs dated after the newest stored date."""
    spark = payloads.sparkSession
    rows = shape_player_logs(payloads, columns, active)
    loaded = stored(spark, root, "gamelogs", "player_gamelogs")
    if loaded is not None:
        rows = since_mark(rows, "GAME_DATE", loaded, "GAME_DATE")
    fresh = align_to(rows, target).dropDuplicates()
    return write_table(fresh, root, "gamelogs", "player_gamelogs", "append")


def shape_team_logs(
    payloads: DataFrame, columns: T.StructType, teams: DataFrame, order: Sequence[str]
) -> DataFrame:
    """Complete team-game rows of listed teams; payloads carry SEASON_YEAR."""
    rows = flatten_result_set(payloads, "payload", columns, keep=["SEASON_YEAR"]).dropna("any")
    return members(text.with_matchup(rows), teams, "TEAM_ID", "id").select(*[f"`{c}`" for c in order])


def ingest_team_logs(
    payloads: DataFrame, columns: T.StructType, teams: DataFrame, order: Sequence[str], root: str
) -> str:
    """Replace the seasons that the payloads cover; other seasons stay as stored."""
    path = table_path(root, "gamelogs", "team_gamelogs")
    reload_partition(shape_team_logs(payloads, columns, teams, order), path, "SEASON_YEAR")
    return path


def games_with_plays(logs: DataFrame, plays: DataFrame | None) -> DataFrame:
    """Games (bare id, date, season) since play-by-play began that have no stored plays yet."""
    games = logs.filter(season_id_filter("SEASON_ID")).select(
        F.col("Game_ID").alias("gameId"),
        "GAME_DATE",
        text.season_year("SEASON_ID").alias("SEASON"),
    )
    return new_keys(games, plays, "gameId")


def ingest_plays(payloads: DataFrame, logs: DataFrame, root: str) -> str:
    """Append the plays of new games, stamped with their game's date and season."""
    spark = payloads.sparkSession
    wanted = games_with_plays(logs, stored(spark, root, "gamelogs", "play_by_play"))
    plays = flatten_result_set(payloads, "payload", PLAY_COLUMNS)
    keyed = plays.withColumn("__bare", text.strip_zeros("gameId"))
    fresh = keyed.join(wanted.withColumnRenamed("gameId", "__bare"), "__bare", "inner").drop("__bare")
    return write_table(text.blank_to_null(fresh), root, "gamelogs", "play_by_play", "append")


def games_with_boxscores(logs: DataFrame, loaded: DataFrame | None, since: int = 1996) -> DataFrame:
    """Games (bare id, date, season) from season ``since`` on that are not stored yet."""
    games = logs.select(
        F.col("Game_ID").alias("game_id"),
        F.col("GAME_DATE").alias("date"),
        text.season_year("SEASON_ID").alias("season"),
    ).filter(F.col("season") >= since)
    return new_keys(games, loaded, "game_id")


def shape_boxscores(
    payloads: DataFrame, statistics: list[str], wanted: DataFrame, with_team: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(team rows, player rows) of the wanted games, in snake_case with date and season."""

    def dated(rows: DataFrame) -> DataFrame:
        keyed = rows.withColumn("__bare", text.strip_zeros("game_id"))
        games = wanted.withColumnRenamed("game_id", "__bare")
        return text.snake_columns(keyed.join(games, "__bare", "inner").drop("__bare"))

    return (
        dated(flatten_team_boxscore(payloads, "payload", statistics)),
        dated(explode_player_boxscore(payloads, "payload", statistics, with_team=with_team)),
    )


def ingest_boxscores(
    payloads: DataFrame, statistics: list[str], logs: DataFrame, root: str, kind: str = "misc"
) -> tuple[str, str]:
    """Append team and player metrics (``misc`` or ``advanced``) of games that are not stored yet."""
    spark = payloads.sparkSession
    names = (f"team_{kind}_metrics", f"player_{kind}_metrics")
    paths = []
    for i, name in enumerate(names):
        # Stored before it meets the documents: where no game is new, the plan sees that and leaves them unparsed.
        wanted = stage(games_with_boxscores(logs, stored(spark, root, "gamelogs", name)), "wanted-games")
        rows = shape_boxscores(payloads, statistics, wanted, with_team=kind == "misc")[i]
        paths.append(write_table(rows, root, "gamelogs", name, "append"))
    return paths[0], paths[1]


def shape_lineups(payloads: DataFrame, columns: T.StructType) -> DataFrame:
    """Lineup totals without rank columns, ids as arrays; payloads carry season and period."""
    rows = flatten_result_set(payloads, "payload", columns, keep=["season", "period"])
    return text.drop_ranks(rows.withColumn("GROUP_ID", text.id_list("GROUP_ID")).drop("GROUP_SET"))


def ingest_lineups(payloads: DataFrame, columns: T.StructType, root: str) -> str:
    """All seasons and periods in one write."""
    return write_table(shape_lineups(payloads, columns), root, "season_metrics", "lineup_totals", "replace")


def shape_champions(payloads: DataFrame) -> DataFrame:
    """Titles per team; payloads carry TEAM, and titles are the fourth result set."""
    return flatten_result_set(payloads, "payload", CHAMPION_COLUMNS, index=3, keep=["TEAM"])


def ingest_champions(payloads: DataFrame, root: str) -> str:
    return write_table(shape_champions(payloads), root, "general", "champions", "replace")


def shape_players(payloads: DataFrame, columns: T.StructType) -> DataFrame:
    """Player bios with draft fields as numbers."""
    rows = flatten_result_set(payloads, "payload", columns)
    draft = [c for c in ("DRAFT_YEAR", "DRAFT_ROUND", "DRAFT_NUMBER") if c in rows.columns]
    return rows.withColumns({c: text.draft_number(c) for c in draft})


def ingest_players(payloads: DataFrame, columns: T.StructType, root: str) -> str:
    return write_table(shape_players(payloads, columns), root, "general", "players", "replace")


def restore_table(backup: DataFrame, root: str, schema: str, table: str) -> str:
    """Replace a table by a backup read with ``read_csv``."""
    return write_table(backup, root, schema, table, "replace")


@dataclass
class LinesLoad:
    """What a load of lines did: the table's path, its counts, and the per-key changes (none on a first load)."""

    path: str
    counts: dict[str, int]
    changes: DataFrame | None
    rejects: DataFrame


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def ingest_lines(spark: SparkSession, landed_path: str, columns: T.StructType, root: str) -> LinesLoad:
    """Replace ``general.lines`` by a landed snapshot of all lines, writing only what changed.

    The landing (newline-delimited JSON) is parsed with rejects kept apart (``general.lines_rejects``, appended with
    their file). Exact duplicate records count once. The result equals a full replacement by the landing: the
    snapshot is compared with the stored table by ``game_id`` and row hash (``snapshot_diff``), and only season
    partitions holding a new, changed or vanished row are rewritten (dynamic partition overwrite); a season left
    without rows is deleted. Counts (landed, rejected, rows, new, changed, equal, vanished, seasons written and
    removed) come from ``observe`` on passes that run anyway.
    """
    from hoopline.plans.lines import with_underdog

    landed: Landed = read_landed(spark, landed_path, columns)
    write_table(landed.rejects.withColumn("landing", F.lit(landed_path)), root, "general", "lines_rejects", "append")
    shaped = with_underdog(landed.rows.dropDuplicates()).withColumn("season", F.substring("game_date", 1, 4))
    # The write, the diff, the rewrite and the counts all read the distinct rows, so they are stored once.
    shaped = stage(shaped, "lines-shaped")
    compared = [c for c in shaped.columns if c != "season"]
    path = table_path(root, "general", "lines")
    counts = dict(landed.counts)
    if not table_exists(spark, root, "general", "lines"):
        seen = Observation("first lines")
        write_table(shaped.observe(seen, F.count(F.lit(1)).alias("new")), root, "general", "lines", "fail", ["season"])
        counts |= {"new": int(seen.get["new"]), "changed": 0, "equal": 0, "vanished": 0}
        counts["seasons_written"] = shaped.select("season").distinct().count()
        counts["seasons_removed"] = 0
        return LinesLoad(path, counts, None, landed.rejects)
    stored = spark.read.schema(shaped.schema).parquet(path)  # season stays text, as written
    seen = Observation("lines diff")
    changes = stage(
        snapshot_diff(shaped, stored, ["game_id"], compared, "season").observe(seen, *status_counts(F.col("status"))),
        "lines-diff",
    )
    counts |= {k: int(v) for k, v in seen.get.items()}
    touched = stage(
        changes.where(F.col("status") != "equal")
        .select(F.explode(F.array_union("landed_parts", "stored_parts")).alias("season"))
        .distinct(),
        "lines-seasons",
    )
    rewritten = shaped.join(touched, "season", "left_semi")
    reload_partition(rewritten, path, "season")
    # One row per season: a bounded list.
    emptied = [r.season for r in touched.join(shaped.select("season").distinct(), "season", "left_anti").collect()]
    for season in emptied:
        _delete(spark, f"{path}/season={season}")
    counts["seasons_written"] = touched.count() - len(emptied)
    counts["seasons_removed"] = len(emptied)
    return LinesLoad(path, counts, changes, landed.rejects)

"""Landed JSON payloads turned into typed rows with ``from_json`` and generators."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoopline.session import stage

RESULT_SETS = T.StructType(
    [
        T.StructField(
            "resultSets",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("headers", T.ArrayType(T.StringType())),
                        T.StructField("rowSet", T.ArrayType(T.ArrayType(T.StringType()))),
                    ]
                )
            ),
        )
    ]
)


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed payload file, with its path and its text."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("payload_file"), F.col("value").alias("payload")
    )


#: The column that holds a line that did not parse.
CORRUPT = "_corrupt_record"


@dataclass
class Landed:
    """Parsed rows, the lines that did not parse (with their file), and counts of both."""

    rows: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def read_landed(spark: SparkSession, path: str, schema: T.StructType) -> Landed:
    """Newline-delimited JSON records as typed rows, and every line that does not parse as a reject.

    A line that is no JSON object, or whose value does not fit its declared type, is a reject as a whole; blank
    lines are no records. The parse is stored once, and ``observe`` counts lines and rejects in that same pass,
    so ``rows + rejected == landed`` holds by construction and nothing is lost without a trace.
    """
    declared = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = (
        spark.read.schema(declared)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
        .withColumn("landed_file", F.col("_metadata.file_path"))
    )
    seen = Observation("landed")
    held = stage(
        parsed.observe(seen, F.count(F.lit(1)).alias("landed"), F.count(CORRUPT).alias("rejected")), "landed"
    )
    counts = {k: int(v) for k, v in seen.get.items()}
    counts["rows"] = counts["landed"] - counts["rejected"]
    rows = held.where(F.col(CORRUPT).isNull()).drop(CORRUPT, "landed_file")
    rejects = held.where(F.col(CORRUPT).isNotNull()).select("landed_file", F.col(CORRUPT).alias("record"))
    return Landed(rows, rejects, counts)


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, columns: list[str] | None = None
) -> DataFrame:
    """Files holding a JSON array of flat records."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path)
    return rows.select(*columns) if columns else rows


def flatten_records(df: DataFrame, payload: str, schema: T.StructType, keep: list[str] = ()) -> DataFrame:
    """A column holding a JSON array of flat records, one output row per record."""
    return df.select(*keep, F.inline(F.from_json(payload, T.ArrayType(schema))))


def flatten_result_set(
    df: DataFrame, payload: str, schema: T.StructType, index: int = 0, keep: list[str] = ()
) -> DataFrame:
    """Headers plus positional rows to named, typed columns.

    Values are found by header name, so payloads may order their columns differently; a header that
    is absent gives null, and so does a value that does not cast.
    """
    parsed = df.select(*keep, F.from_json(payload, RESULT_SETS)["resultSets"][index].alias("__set"))
    return _set_rows(parsed, schema, keep)


def _set_rows(parsed: DataFrame, schema: T.StructType, keep) -> DataFrame:
    rows = parsed.select(
        *keep, F.col("__set.headers").alias("__headers"), F.explode("__set.rowSet").alias("__row")
    )

    def value(field: T.StructField) -> Column:
        position = F.array_position("__headers", F.lit(field.name)).cast("int")
        # get() is 0-based and gives null outside the array, so a missing header (-1) is null.
        return F.get(F.col("__row"), position - 1).try_cast(field.dataType).alias(field.name)

    return rows.select(*keep, *[value(f) for f in schema.fields])


def parse_documents(
    df: DataFrame, payload: str, schema: T.StructType, checks: list[tuple[str, Column]] = (), keep: list[str] = ()
) -> Landed:
    """Each landed document parsed once: those that pass as ``doc``, the others as rejects with a reason.

    Reasons, first that applies: ``null`` (no payload), ``malformed`` (no JSON, or a value of the wrong type),
    then the name of each failed check (a condition on ``doc`` that is true for a bad document). The parse is
    stored once; ``observe`` counts documents and rejects in that pass. Columns ``keep`` go along both ways.
    """
    probe = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    doc = F.from_json(payload, probe, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    reason = F.when(F.col(payload).isNull(), "null").when(F.col(f"doc.{CORRUPT}").isNotNull(), "malformed")
    for name, bad in checks:
        reason = reason.when(bad, name)
    seen = Observation("documents")
    held = stage(
        df.select(*keep, payload, doc.alias("doc"))
        .withColumn("reason", reason)
        .observe(seen, F.count(F.lit(1)).alias("documents"), F.count("reason").alias("rejected")),
        "documents",
    )
    counts = {k: int(v) for k, v in seen.get.items()}
    counts["parsed"] = counts["documents"] - counts["rejected"]
    rows = held.where(F.col("reason").isNull()).select(*keep, F.col("doc").dropFields(CORRUPT).alias("doc"))
    rejects = held.where(F.col("reason").isNotNull()).select(*keep, payload, "reason")
    return Landed(rows, rejects, counts)


def checked_result_set(
    df: DataFrame, payload: str, schema: T.StructType, index: int = 0, keep: list[str] = ()
) -> Landed:
    """``flatten_result_set`` with rejects: a document without result set ``index`` is one (``no result set``)."""
    missing = F.coalesce(F.size("doc.resultSets"), F.lit(-1)) <= index
    docs = parse_documents(df, payload, RESULT_SETS, [("no result set", missing)], keep)
    rows = _set_rows(docs.rows.select(*keep, F.col("doc.resultSets")[index].alias("__set")), schema, keep)
    return Landed(rows, docs.rejects, docs.counts)


def _statistics(keys: list[str]) -> T.StructType:
    return T.StructType([T.StructField(k, T.DoubleType()) for k in keys])


def boxscore_schema(statistics: list[str]) -> T.StructType:
    """The nested box-score document for a declared list of statistics."""
    player = T.StructType(
        [
            T.StructField("personId", T.LongType()),
            T.StructField("playerSlug", T.StringType()),
            T.StructField("statistics", _statistics(statistics)),
        ]
    )
    team = T.StructType(
        [
            T.StructField("teamId", T.LongType()),
            T.StructField("statistics", _statistics(statistics)),
            T.StructField("players", T.ArrayType(player)),
        ]
    )
    return T.StructType(
        [
            T.StructField("gameId", T.StringType()),
            T.StructField("homeTeamId", T.LongType()),
            T.StructField("awayTeamId", T.LongType()),
            T.StructField("homeTeam", team),
            T.StructField("awayTeam", team),
        ]
    )


def flatten_team_boxscore(
    df: DataFrame, payload: str, statistics: list[str], keep: list[str] = ()
) -> DataFrame:
    """One row per game; each side's statistics get a ``home_`` or ``away_`` prefix."""
    doc = df.select(*keep, F.from_json(payload, boxscore_schema(statistics)).alias("d"))
    return _team_rows(doc, statistics, keep)


def _team_rows(doc: DataFrame, statistics: list[str], keep) -> DataFrame:
    sides = [
        F.col(f"d.{side}Team.statistics.{k}").alias(f"{side}_{k}")
        for side in ("home", "away")
        for k in statistics
    ]
    return doc.select(
        F.col("d.gameId").alias("game_id"),
        F.col("d.awayTeamId").alias("away_team_id"),
        F.col("d.homeTeamId").alias("home_team_id"),
        *keep,
        *sides,
    )


def explode_player_boxscore(
    df: DataFrame, payload: str, statistics: list[str], keep: list[str] = (), with_team: bool = True
) -> DataFrame:
    """One row per player of either side."""
    doc = df.select(*keep, F.from_json(payload, boxscore_schema(statistics)).alias("d"))
    return _player_rows(doc, statistics, keep, with_team)


def checked_boxscores(df: DataFrame, payload: str, statistics: list[str], keep: list[str] = ()) -> Landed:
    """Box-score documents parsed once, with rejects: a document without ``gameId`` is one (``no game``).

    ``rows`` holds ``keep`` and the parsed document ``d``; give it to ``team_rows`` or ``player_rows``.
    """
    docs = parse_documents(df, payload, boxscore_schema(statistics), [("no game", F.col("doc.gameId").isNull())], keep)
    return Landed(docs.rows.withColumnRenamed("doc", "d"), docs.rejects, docs.counts)


def team_rows(parsed: DataFrame, statistics: list[str], keep: list[str] = ()) -> DataFrame:
    return _team_rows(parsed, statistics, keep)


def player_rows(parsed: DataFrame, statistics: list[str], keep: list[str] = (), with_team: bool = True) -> DataFrame:
    return _player_rows(parsed, statistics, keep, with_team)


def _player_rows(doc: DataFrame, statistics: list[str], keep, with_team: bool) -> DataFrame:
    sides = F.array(
        *[
            F.struct(
                F.lit(side).alias("home_away"),
                F.col(f"d.{side}Team.teamId").alias("team_id"),
                F.col(f"d.{side}Team.players").alias("players"),
            )
            for side in ("home", "away")
        ]
    )
    per_side = doc.select(F.col("d.gameId").alias("game_id"), *keep, F.inline(sides))
    per_player = per_side.withColumn("p", F.explode("players"))
    return per_player.select(
        "game_id",
        *keep,
        *(["team_id"] if with_team else []),
        "home_away",
        F.col("p.personId").alias("player_id"),
        F.col("p.playerSlug").alias("player_slug"),
        *[F.col(f"p.statistics.{k}").alias(k) for k in statistics],
    )


_LINEUP_PLAYER = T.StructType(
    [
        T.StructField("personId", T.LongType()),
        T.StructField("firstName", T.StringType()),
        T.StructField("lastName", T.StringType()),
        T.StructField("playerName", T.StringType()),
        T.StructField("lineupStatus", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("rosterStatus", T.StringType()),
    ]
)
_LINEUP_TEAM = T.StructType(
    [
        T.StructField("teamId", T.LongType()),
        T.StructField("teamAbbreviation", T.StringType()),
        T.StructField("players", T.ArrayType(_LINEUP_PLAYER)),
    ]
)
LINEUPS = T.StructType(
    [
        T.StructField(
            "games",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("gameId", T.StringType()),
                        T.StructField("homeTeam", _LINEUP_TEAM),
                        T.StructField("awayTeam", _LINEUP_TEAM),
                    ]
                )
            ),
        )
    ]
)


def lineup_players(df: DataFrame, payload: str) -> DataFrame:
    """Active players of both sides of every game in daily lineup payloads, without repeats."""
    games = df.select(F.inline(F.from_json(payload, LINEUPS)["games"]))
    sides = games.select(
        "gameId",
        F.inline(
            F.array(
                F.struct(F.lit("home").alias("home_away"), F.col("homeTeam").alias("team")),
                F.struct(F.lit("away").alias("home_away"), F.col("awayTeam").alias("team")),
            )
        ),
    )
    players = sides.select(
        "gameId",
        F.col("team.teamId").alias("teamId"),
        F.col("team.teamAbbreviation").alias("teamAbbreviation"),
        F.inline("team.players"),
        "home_away",
    )
    return (
        players.filter(F.col("rosterStatus") == "Active")
        .drop("lineupStatus", "position")
        .dropDuplicates()
    )

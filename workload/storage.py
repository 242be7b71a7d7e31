"""Sources, sinks and ingest plans. Queries that write use a fresh folder below the staging root."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoopline.plans import ingest
from hoopline.session import stage, staging_root
from hoopline.sources import html, json_arrays, payloads, tables
from workload import sql as S
from workload.registry import query
from workload.views import games, player_logs, raw_lines, table


def _folder(spark):
    return f"{staging_root(spark)}/tables-{uuid.uuid4().hex}"


SUPPLIER = T.StructType(
    [
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()),
        T.StructField("s_acctbal", T.DoubleType()),
    ]
)


@query("s1_scan_table", "select * from lineitem")
def s1(spark, sf):
    return table(spark, sf, "lineitem")


@query(
    "s2_scan_by_sql",
    "select o_orderpriority, count(*) as orders, round(avg(o_totalprice), 4) as average_price from orders group by 1",
)
def s2(spark, sf):
    return tables.run_sql(
        spark,
        "select o_orderpriority, count(*) as orders, round(avg(o_totalprice), 4) as average_price from {orders} group by 1",
        orders=table(spark, sf, "orders"),
    )


@query("s3_csv_scan", "select * from supplier")
def s3(spark, sf):
    path = f"{_folder(spark)}/supplier"
    tables.write_csv(table(spark, sf, "supplier"), path)
    return tables.read_csv(spark, path, SUPPLIER)


@query("s12_csv_report", "select c_mktsegment, count(*) as customers from customer group by 1")
def s12(spark, sf):
    path = f"{_folder(spark)}/report"
    tables.write_csv(table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("customers")), path)
    schema = T.StructType([T.StructField("c_mktsegment", T.StringType()), T.StructField("customers", T.LongType())])
    return tables.read_csv(spark, path, schema)


@query("s4_flat_records", "select event_id, user_id, event_type from events")
def s4(spark, sf):
    record = F.to_json(F.array(F.struct("event_id", "user_id", "event_type", "value")))
    landed = table(spark, sf, "events").select(record.alias("payload"))
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
        ]
    )
    return payloads.flatten_records(landed, "payload", schema)


@query("s4_json_props", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def s4_props(spark, sf):
    landed = table(spark, sf, "events").select("event_id", F.concat(F.lit("["), "props", F.lit("]")).alias("payload"))
    return payloads.flatten_records(landed, "payload", T.StructType([T.StructField("k", T.LongType())]), keep=["event_id"])


def _result_sets(key, sets):
    """Result-set text from [(headers, row values)]; odd keys list their columns in reverse."""

    def one(headers, values):
        texts = [v.cast("string") for v in values]
        ordered = lambda items: F.when(key % 2 == 0, F.array(*items)).otherwise(F.array(*reversed(items)))
        return F.struct(
            ordered([F.lit(h) for h in headers]).alias("headers"), F.array(ordered(texts)).alias("rowSet")
        )

    return F.to_json(F.struct(F.array(*[one(h, v) for h, v in sets]).alias("resultSets")))


@query(
    "s5_result_set",
    """select c_custkey, c_name, c_acctbal, cast(null as varchar) as missing, cast(null as int) as not_a_number from customer""",
)
def s5(spark, sf):
    c = table(spark, sf, "customer")
    columns = ["c_custkey", "c_name", "c_acctbal"]
    text = _result_sets(
        F.col("c_custkey"),
        [([*columns, "not_a_number"], [*[F.col(x) for x in columns], F.lit("n/a")])],
    )
    schema = T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("missing", T.StringType()),
            T.StructField("not_a_number", T.IntegerType()),
        ]
    )
    return payloads.checked_result_set(c.select(text.alias("payload")), "payload", schema).rows


STATISTICS = ["pointsPaint", "pointsFastBreak"]


def boxscores(spark, sf):
    """One nested box-score document per game; each side lists two players."""
    g = games(spark, sf)

    def team(side):
        def statistics(paint, fast):
            return F.struct(paint.alias("pointsPaint"), fast.alias("pointsFastBreak"))

        paint, fast = F.col(f"{side}_paint"), F.col(f"{side}_fast_break")

        def player(n):
            return F.struct(
                (F.col(f"{side}_id") * 10 + n).alias("personId"),
                F.concat(F.lit(f"{side}-player-{n}-"), F.col("game_key").cast("string")).alias("playerSlug"),
                statistics(paint + n, fast - n).alias("statistics"),
            )

        return F.struct(
            F.col(f"{side}_id").alias("teamId"), statistics(paint, fast).alias("statistics"),
            F.array(player(1), player(2)).alias("players"),
        )

    doc = F.struct(
        F.lpad(F.col("game_key").cast("string"), 10, "0").alias("gameId"),
        F.col("home_id").alias("homeTeamId"), F.col("away_id").alias("awayTeamId"),
        team("home").alias("homeTeam"), team("away").alias("awayTeam"),
    )
    return g.select(F.to_json(doc).alias("payload"))


@query(
    "s6_team_boxscore",
    f"""with {S.GAMES} select lpad(cast(game_key as varchar), 10, '0') as game_id, away_id as away_team_id,
  home_id as home_team_id, home_paint as "home_pointsPaint", home_fast_break as "home_pointsFastBreak",
  away_paint as "away_pointsPaint", away_fast_break as "away_pointsFastBreak" from games""",
)
def s6(spark, sf):
    return payloads.team_rows(payloads.checked_boxscores(boxscores(spark, sf), "payload", STATISTICS).rows, STATISTICS)


_PLAYER_BOX = " union all ".join(
    f"""select game_key, season, game_date, '{side}' as home_away, {side}_id as team_id, {side}_id * 10 + {n} as player_id,
  '{side}-player-{n}-' || cast(game_key as varchar) as player_slug, {side}_paint + {n} as paint, {side}_fast_break - {n} as fast
  from games"""
    for side in ("home", "away")
    for n in (1, 2)
)


@query(
    "s7_player_boxscore",
    f"""with {S.GAMES} select lpad(cast(game_key as varchar), 10, '0') as game_id, team_id, home_away, player_id,
  player_slug, paint as "pointsPaint", fast as "pointsFastBreak" from ({_PLAYER_BOX})""",
)
def s7(spark, sf):
    return payloads.player_rows(payloads.checked_boxscores(boxscores(spark, sf), "payload", STATISTICS).rows, STATISTICS)


@query(
    "s9_list_items",
    """with items as (select page_id, unnest(regexp_extract_all(html, '(?s)<li\\b[^>]*>(.*?)</li>', 1)) as item,
  generate_subscripts(regexp_extract_all(html, '(?s)<li\\b[^>]*>(.*?)</li>', 1), 1) - 1 as item_no from pages)
select page_id, cast(item_no as int) as item_no, regexp_replace(item, '(?s)<[^>]*>', '', 'g') as item_text from items""",
)
def s9(spark, sf):
    return html.extract_html_items(table(spark, sf, "pages"), "html", ["page_id"])


@query(
    "s10_write_modes",
    """select s_suppkey, s_name, 2 as copies from supplier""",
)
def s10(spark, sf):
    root = _folder(spark)
    rows = table(spark, sf, "supplier")
    tables.write_table(rows, root, "general", "supplier", "fail")
    tables.write_table(rows, root, "general", "supplier", "replace")
    tables.write_table(rows, root, "general", "supplier", "append")
    stored = tables.read_table(spark, root, "general", "supplier", SUPPLIER)
    return stored.groupBy("s_suppkey", "s_name").agg(F.count(F.lit(1)).cast("int").alias("copies"))


@query(
    "s11_reload_season",
    """select cast(year(o_orderdate) as int) as season, count(*) as games,
  count(case when year(o_orderdate) = 1998 then 1 end) as reloaded from orders group by 1""",
)
def s11(spark, sf):
    path = f"{_folder(spark)}/orders"
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    tables.reload_partition(rows.withColumn("version", F.lit(1)), path, "season")
    tables.reload_partition(rows.filter("season = 1998").withColumn("version", F.lit(2)), path, "season")
    stored = spark.read.parquet(path)
    return stored.groupBy("season").agg(
        F.count(F.lit(1)).alias("games"), F.count(F.when(F.col("version") == 2, 1)).alias("reloaded")
    )


@query("s14_align_to_table", "select cast(s_suppkey as varchar) as s_suppkey, cast(round(s_acctbal) as int) as s_acctbal, s_name from supplier")
def s14(spark, sf):
    target = T.StructType(
        [
            T.StructField("s_suppkey", T.StringType()),
            T.StructField("s_acctbal", T.IntegerType()),
            T.StructField("s_name", T.StringType()),
        ]
    )
    rows = table(spark, sf, "supplier").withColumn("s_acctbal", F.round("s_acctbal"))
    return tables.align_to(rows, target)


LOG_COLUMNS = T.StructType(
    [
        T.StructField("SEASON_ID", T.StringType()),
        T.StructField("Player_ID", T.LongType()),
        T.StructField("Game_ID", T.StringType()),
        T.StructField("GAME_DATE", T.StringType()),
        T.StructField("MATCHUP", T.StringType()),
        T.StructField("WL", T.StringType()),
        T.StructField("PTS", T.DoubleType()),
        T.StructField("LINE_NO", T.IntegerType()),
    ]
)
LOG_TARGET = T.StructType(
    [
        T.StructField("SEASON_ID", T.StringType()),
        T.StructField("Player_ID", T.LongType()),
        T.StructField("Game_ID", T.StringType()),
        T.StructField("GAME_DATE", T.DateType()),
        T.StructField("WL", T.StringType()),
        T.StructField("PTS", T.DoubleType()),
        T.StructField("LINE_NO", T.IntegerType()),
        T.StructField("TEAM", T.StringType()),
        T.StructField("OPPONENT", T.StringType()),
        T.StructField("HOME/AWAY", T.StringType()),
        T.StructField("player_name", T.StringType()),
    ]
)


def log_payloads(logs):
    """Player logs as landed documents with text dates and matchups."""
    word = F.when(F.col("`HOME/AWAY`") == "AWAY", " @ ").otherwise(" vs. ")
    day = F.when(F.col("LINE_NO") % 2 == 0, F.upper(F.date_format("GAME_DATE", "MMM d, yyyy"))).otherwise(
        F.date_format("GAME_DATE", "yyyy-MM-dd")
    )
    values = {
        "SEASON_ID": F.col("SEASON_ID"), "Player_ID": F.col("Player_ID"), "Game_ID": F.col("Game_ID"),
        "GAME_DATE": day, "MATCHUP": F.concat("TEAM", word, "OPPONENT"), "WL": F.col("WL"),
        "PTS": F.col("PTS"), "LINE_NO": F.col("LINE_NO"),
    }
    return logs.select(_result_sets(F.col("LINE_NO"), [(list(values), list(values.values()))]).alias("payload"))


def active_players(spark, sf):
    s = table(spark, sf, "supplier").filter("s_suppkey % 10 <> 3")  # some logged players are not listed
    return s.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("full_name"))


@query(
    "q11_ingest_player_logs",
    f"""with {S.PLAYER_LOG} select distinct "SEASON_ID", "Player_ID", "Game_ID", "GAME_DATE", "WL", "PTS", "LINE_NO", "TEAM",
  "OPPONENT", "HOME/AWAY", s_name as player_name from player_log join supplier on s_suppkey = "Player_ID"
where s_suppkey % 10 <> 3""",
)
def q11_player_logs(spark, sf):
    """Three loads: half the seasons, everything, everything again; the last must add nothing."""
    root = _folder(spark)
    # All loads land rows of the same logs, so the logs are made once and stored.
    logs, active = stage(player_logs(spark, sf), "landed-logs"), active_players(spark, sf)
    for part in (logs.filter(F.year("GAME_DATE") < 1998), logs, logs):
        ingest.ingest_player_logs(log_payloads(part), LOG_COLUMNS, active, LOG_TARGET, root)
    return tables.read_table(spark, root, "gamelogs", "player_gamelogs", LOG_TARGET)


@query(
    "q11_ingest_team_logs",
    f"""with {S.TEAM_LOG} select "TEAM_ID", "GAME_ID", "WL", "PTS", "SEASON_YEAR", "TEAM", "OPPONENT", "HOME/AWAY"
from team_log where "TEAM_ID" < 20""",
)
def q11_team_logs(spark, sf):
    """A full load, then a reload of the last season."""
    from workload.views import team_logs

    root = _folder(spark)
    logs = team_logs(spark, sf)
    values = {c: F.col(c) for c in ("TEAM_ID", "GAME_ID", "MATCHUP", "WL", "PTS")}
    text = _result_sets(F.col("TEAM_ID"), [(list(values), list(values.values()))])
    landed = logs.select(text.alias("payload"), "SEASON_YEAR")
    columns = T.StructType(
        [
            T.StructField("TEAM_ID", T.LongType()),
            T.StructField("GAME_ID", T.StringType()),
            T.StructField("MATCHUP", T.StringType()),
            T.StructField("WL", T.StringType()),
            T.StructField("PTS", T.DoubleType()),
        ]
    )
    teams = table(spark, sf, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").cast("bigint").alias("id"))
    order = ["TEAM_ID", "GAME_ID", "WL", "PTS", "SEASON_YEAR", "TEAM", "OPPONENT", "HOME/AWAY"]
    path = ingest.ingest_team_logs(landed, columns, teams, order, root)
    last = logs.agg(F.max("SEASON_YEAR")).scalar()
    ingest.ingest_team_logs(landed.filter(F.col("SEASON_YEAR") == last), columns, teams, order, root)
    return spark.read.parquet(path).select(*[f"`{c}`" for c in order])


@query(
    "q11_ingest_boxscores",
    f"""with {S.GAMES} select 'team' as kind, cast(null as bigint) as player_id, game_id, date, season, a, b from
  (select lpad(cast(game_key as varchar), 10, '0') as game_id, game_date as date, season, home_paint as a, away_paint as b from games)
where season >= 1996 union all
select 'player', player_id, lpad(cast(game_key as varchar), 10, '0'), game_date, season, paint, fast from ({_PLAYER_BOX})
where season >= 1996""",
)
def q11_boxscores(spark, sf):
    """Loaded twice; the second run finds no new games."""
    root = _folder(spark)
    # Landed documents and stored logs are read by every load, so both are made once and stored.
    docs = stage(boxscores(spark, sf), "landed-boxscores")
    logs = stage(player_logs(spark, sf).select("SEASON_ID", "Game_ID", "GAME_DATE"), "stored-logs")
    for _ in range(2):
        team_path, player_path = ingest.ingest_boxscores(docs, STATISTICS, logs, root)
    team = spark.read.parquet(team_path).select(
        F.lit("team").alias("kind"), F.lit(None).cast("bigint").alias("player_id"), "game_id", "date", "season",
        F.col("home_points_paint").alias("a"), F.col("away_points_paint").alias("b"),
    )
    player = spark.read.parquet(player_path).select(
        F.lit("player").alias("kind"), "player_id", "game_id", "date", "season",
        F.col("points_paint").alias("a"), F.col("points_fast_break").alias("b"),
    )
    return team.unionByName(player)


@query(
    "q11_ingest_plays",
    f"""with {S.PLAYER_LOG} select "Game_ID" as "gameId", "LINE_NO" as "actionNumber", "Player_ID" as "personId",
  case when "LINE_NO" % 2 = 0 then 'Shot' end as "actionType", "GAME_DATE", season as "SEASON" from player_log
where cast("SEASON_ID" as int) >= 21996""",
)
def q11_plays(spark, sf):
    """Loaded twice; the second run finds no new games."""
    root = _folder(spark)
    logs = player_logs(spark, sf)
    values = {
        "gameId": F.col("Game_ID"), "actionNumber": F.col("LINE_NO"), "personId": F.col("Player_ID"),
        "actionType": F.when(F.col("LINE_NO") % 2 == 0, "Shot").otherwise(""),
    }
    landed = logs.select(_result_sets(F.col("LINE_NO"), [(list(values), list(values.values()))]).alias("payload"))
    for _ in range(2):
        path = ingest.ingest_plays(landed, logs, root)
    return spark.read.parquet(path).select("gameId", "actionNumber", "personId", "actionType", "GAME_DATE", "SEASON")


@query(
    "q11_ingest_lineups",
    """select [cast(l_partkey as varchar), cast(l_suppkey as varchar)][1] as first_id, l_quantity as min, 2000 + l_linenumber as season,
  l_linenumber % 5 as period from lineitem""",
)
def q11_lineups(spark, sf):
    rows = table(spark, sf, "lineitem")
    ids = F.concat(F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), F.lit("-"))
    values = {"GROUP_SET": F.lit("Lineups"), "GROUP_ID": ids, "MIN": F.col("l_quantity"), "MIN_RANK": F.lit(1)}
    landed = rows.select(
        _result_sets(F.col("l_partkey"), [(list(values), list(values.values()))]).alias("payload"),
        (2000 + F.col("l_linenumber")).alias("season"), (F.col("l_linenumber") % 5).alias("period"),
    )
    columns = T.StructType(
        [
            T.StructField("GROUP_SET", T.StringType()),
            T.StructField("GROUP_ID", T.StringType()),
            T.StructField("MIN", T.DoubleType()),
            T.StructField("MIN_RANK", T.IntegerType()),
        ]
    )
    path = ingest.ingest_lineups(landed, columns, _folder(spark))
    stored = spark.read.parquet(path)
    return stored.select(F.col("group_id")[0].alias("first_id"), "min", "season", "period")


@query(
    "q11_ingest_champions",
    """select c_name as "TEAM", cast(1950 + c_custkey % 70 as int) as "YEARAWARDED", c_mktsegment as "OPPOSITETEAM" from customer""",
)
def q11_champions(spark, sf):
    c = table(spark, sf, "customer")
    empty = (["X"], [F.lit("y")])
    title = (["YEARAWARDED", "OPPOSITETEAM"], [1950 + F.col("c_custkey") % 70, F.col("c_mktsegment")])
    landed = c.select(
        F.col("c_name").alias("TEAM"), _result_sets(F.col("c_custkey"), [empty, empty, empty, title]).alias("payload")
    )
    return spark.read.parquet(ingest.ingest_champions(landed, _folder(spark)))


@query(
    "q11_ingest_players",
    f"""with {S.PLAYERS} select "PERSON_ID", "HEIGHT", case when "DRAFT_YEAR" = 'Undrafted' then 0 else cast("DRAFT_YEAR" as int) end
  as "DRAFT_YEAR", coalesce(cast("DRAFT_NUMBER" as int), 0) as "DRAFT_NUMBER" from players""",
)
def q11_players(spark, sf):
    from workload.views import players

    p = players(spark, sf)
    names = ["PERSON_ID", "HEIGHT", "DRAFT_YEAR", "DRAFT_NUMBER"]
    landed = p.select(_result_sets(F.col("PERSON_ID"), [(names, [F.col(n) for n in names])]).alias("payload"))
    columns = T.StructType(
        [
            T.StructField("PERSON_ID", T.LongType()),
            T.StructField("HEIGHT", T.StringType()),
            T.StructField("DRAFT_YEAR", T.StringType()),
            T.StructField("DRAFT_NUMBER", T.StringType()),
        ]
    )
    return spark.read.parquet(ingest.ingest_players(landed, columns, _folder(spark)))


# Two landings of all lines. The earlier one lacks some games (new later), prices others differently (changed
# later) and has games that the later one drops (vanished); both carry broken records besides all real ones.
LINE_ORDER = [
    "game_id", "game_date", "home_team_abbrev", "visit_team_abbrev", "favorite", "underdog", "line", "spread",
    "game_over_under", "total", "home_team_score", "visit_team_score", "favorite_covered", "underdog_covered",
    "over_hit", "under_hit",
]


def _land_lines(lines, folder, earlier):
    raw = lines
    key = F.expr("try_cast(game_id as bigint)")
    if earlier:
        dropped = lines.where(key % 13 == 0).withColumn("game_id", F.concat(F.lit("V"), "game_id"))
        raw = (
            raw.where(key % 11 != 0)
            .withColumn("spread", F.when(key % 7 == 0, F.col("spread") + 1).otherwise(F.col("spread")))
            .unionByName(dropped)
        )
    record = F.to_json(F.struct(*raw.columns))
    broken = raw.where(key % 17 == 0).select(F.substring(record, 1, 25).alias("value"))
    path = f"{folder}/landing-{'earlier' if earlier else 'later'}"
    raw.select(record.alias("value")).unionByName(broken).write.text(path)
    return path


def _two_line_loads(spark, sf):
    folder = _folder(spark)
    # Both landings, their broken records and the dropped games are made from the same lines: computed once, stored.
    lines = stage(raw_lines(spark, sf), "raw-lines")
    first = ingest.ingest_lines(spark, _land_lines(lines, folder, True), lines.schema, folder)
    second = ingest.ingest_lines(spark, _land_lines(lines, folder, False), lines.schema, folder)
    return first, second


_EARLIER = """earlier as (
  select * replace (case when cast(game_id as bigint) % 7 = 0 then spread + 1 else spread end as spread)
  from lines where cast(game_id as bigint) % 11 <> 0
  union all select * replace ('V' || game_id as game_id) from lines where cast(game_id as bigint) % 13 = 0)"""
_SAME = " and ".join(f"e.{c} is not distinct from l.{c}" for c in LINE_ORDER)


@query("q11_ingest_lines", f"with {S.LINES} select {', '.join(LINE_ORDER)} from lines")
def q11_lines(spark, sf):
    """The stored lines after two landings: the same as replacing the table by the later one."""
    _, second = _two_line_loads(spark, sf)
    return spark.read.parquet(second.path).select(*LINE_ORDER)


@query(
    "q11_lines_changes",
    f"""with {S.LINES}, {_EARLIER}
select coalesce(l.game_id, e.game_id) as game_id,
  case when e.game_id is null then 'new' when l.game_id is null then 'vanished' when {_SAME} then 'equal' else 'changed' end as status
from earlier e full outer join lines l on e.game_id = l.game_id""",
)
def q11_lines_changes(spark, sf):
    """Per game: what the later landing did to the stored lines."""
    _, second = _two_line_loads(spark, sf)
    return second.changes.select("game_id", "status")


@query(
    "q11_lines_counts",
    f"""with {S.LINES}, {_EARLIER},
later as (select * from lines),
counted as (
  select 'first' as load, (select count(*) from earlier) as rows,
    (select count(*) from earlier where try_cast(game_id as bigint) % 17 = 0) as rejected,
    (select count(*) from earlier) as new, 0 as changed, 0 as equal, 0 as vanished
  union all
  select 'second', (select count(*) from later), (select count(*) from later where cast(game_id as bigint) % 17 = 0),
    (select count(*) from later l where cast(game_id as bigint) % 11 = 0),
    (select count(*) from later where cast(game_id as bigint) % 11 <> 0 and cast(game_id as bigint) % 7 = 0),
    (select count(*) from later where cast(game_id as bigint) % 11 <> 0 and cast(game_id as bigint) % 7 <> 0),
    (select count(*) from lines where cast(game_id as bigint) % 13 = 0))
select load, (rows + rejected)::bigint as landed, rejected::bigint as rejected, rows::bigint as rows, new::bigint as new,
  changed::bigint as changed, equal::bigint as equal, vanished::bigint as vanished from counted""",
)
def q11_lines_counts(spark, sf):
    """Counts of both loads: landed lines = rows + rejects; every row new, changed, equal or vanished."""
    first, second = _two_line_loads(spark, sf)
    names = ["landed", "rejected", "rows", "new", "changed", "equal", "vanished"]
    rows = [(label, *[int(load.counts[n]) for n in names]) for label, load in (("first", first), ("second", second))]
    return spark.createDataFrame(rows, "load string, " + ", ".join(f"{n} bigint" for n in names))


# Landings with broken documents besides all real ones: truncated text, documents without what the reader needs,
# and empty payloads.
_CUSTOMER_SET = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType())])


def _customer_landing(spark, sf):
    c = table(spark, sf, "customer")
    text = _result_sets(F.col("c_custkey"), [(["c_custkey", "c_name"], [F.col("c_custkey"), F.col("c_name")])])
    key = F.col("c_custkey")
    return c.select("c_custkey", text.alias("payload")).unionByName(
        c.where(key % 50 == 0).select("c_custkey", F.substring(text, 1, 30).alias("payload"))
    ).unionByName(c.where(key % 70 == 0).select("c_custkey", F.lit('{"resource": "x"}').alias("payload"))).unionByName(
        c.where(key % 90 == 0).select("c_custkey", F.lit(None).cast("string").alias("payload"))
    )


def _boxscore_landing(spark, sf):
    g = games(spark, sf).select("game_key")
    docs = boxscores(spark, sf).select(F.get_json_object("payload", "$.gameId").cast("long").alias("game_key"), "payload")
    key = F.col("game_key")
    return docs.unionByName(docs.where(key % 40 == 0).select("game_key", F.substring("payload", 1, 50).alias("payload"))).unionByName(
        g.where(key % 60 == 0).select("game_key", F.lit('{"homeTeamId": 1}').alias("payload"))
    )


@query(
    "s5_rejects",
    f"""with {S.GAMES}
select 'result set' as source, c_custkey as key, 'malformed' as reason from customer where c_custkey % 50 = 0
union all select 'result set', c_custkey, 'no result set' from customer where c_custkey % 70 = 0
union all select 'result set', c_custkey, 'null' from customer where c_custkey % 90 = 0
union all select 'box score', game_key, 'malformed' from games where game_key % 40 = 0
union all select 'box score', game_key, 'no game' from games where game_key % 60 = 0""",
)
def s5_rejects(spark, sf):
    """Every document that does not parse, with the reason; none is lost without a trace."""
    sets = payloads.checked_result_set(_customer_landing(spark, sf), "payload", _CUSTOMER_SET, keep=["c_custkey"])
    boxes = payloads.checked_boxscores(_boxscore_landing(spark, sf), "payload", STATISTICS, keep=["game_key"])
    return sets.rejects.select(F.lit("result set").alias("source"), F.col("c_custkey").alias("key"), "reason").unionByName(
        boxes.rejects.select(F.lit("box score").alias("source"), F.col("game_key").alias("key"), "reason")
    )


@query(
    "s5_landed_counts",
    f"""with {S.GAMES},
c as (select count(*) as n, count(*) filter (c_custkey % 50 = 0) as a, count(*) filter (c_custkey % 70 = 0) as b,
  count(*) filter (c_custkey % 90 = 0) as z from customer),
g as (select count(*) as n, count(*) filter (game_key % 40 = 0) as a, count(*) filter (game_key % 60 = 0) as b from games)
select 'result set' as source, (n + a + b + z)::bigint as documents, (a + b + z)::bigint as rejected, n::bigint as parsed,
  n::bigint as rows from c
union all select 'box score', (n + a + b)::bigint, (a + b)::bigint, n::bigint, (4 * n)::bigint from g""",
)
def s5_landed_counts(spark, sf):
    """Documents = parsed + rejected, counted while the parse is stored; rows are what the parsed ones give."""
    sets = payloads.checked_result_set(_customer_landing(spark, sf), "payload", _CUSTOMER_SET, keep=["c_custkey"])
    boxes = payloads.checked_boxscores(_boxscore_landing(spark, sf), "payload", STATISTICS, keep=["game_key"])
    out = []
    for source, landed, rows in (
        ("result set", sets, sets.rows),
        ("box score", boxes, payloads.player_rows(boxes.rows, STATISTICS)),
    ):
        c = landed.counts
        out.append((source, c["documents"], c["rejected"], c["parsed"], rows.count()))
    return spark.createDataFrame(out, "source string, documents bigint, rejected bigint, parsed bigint, rows bigint")


def _as_arrays(batches):
    """Each task's records as one JSON array text: '[' first, a comma after every record but the last, ']' last."""
    import pyarrow as pa

    yield pa.RecordBatch.from_pydict({"value": ["["]})
    pending = None
    for batch in batches:
        for text in batch.column(0).to_pylist():
            if pending is not None:
                yield pa.RecordBatch.from_pydict({"value": [pending + ","]})
            pending = text
    yield pa.RecordBatch.from_pydict({"value": [(pending or "") + "]"]})


@query("s4_json_arrays", "select event_id, user_id, event_type from events")
def s4_arrays(spark, sf):
    """Events landed as a few large JSON-array files, read back by byte ranges."""
    events = table(spark, sf, "events")
    path = f"{_folder(spark)}/events-arrays"
    records = events.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value")).alias("value"))
    records.repartition(4).mapInArrow(_as_arrays, "value string").write.text(path)
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
        ]
    )
    return json_arrays.read_array_records(spark, path, schema).rows.select("event_id", "user_id", "event_type")


_GRID_CELLS = [
    (0, 0, "s_name"), (0, 1, "s_name"), (0, 2, "cast(s_suppkey as varchar)"),
    (1, 0, "cast(s_nationkey as varchar)"), (1, 1, "'p' || cast(s_suppkey as varchar) || ' inner'"), (1, 2, "cast(s_suppkey * 7 as varchar)"),
    (2, 0, "cast(s_nationkey as varchar)"), (2, 1, "'x'"), (2, 2, "'y'"),
]


@query(
    "s9_table_grid",
    " union all ".join(f"select s_suppkey, {r} as row_no, {c} as col_no, {v} as text from supplier" for r, c, v in _GRID_CELLS),
)
def s9_grid(spark, sf):
    """A page per supplier whose table has a spanned heading, a spanned first column and a table inside a cell."""
    s = table(spark, sf, "supplier")
    page = F.concat(
        F.lit("<h1>Supplier</h1><table><tr><th colspan=2>"), F.col("s_name"), F.lit("</th><th>"), F.col("s_suppkey").cast("string"),
        F.lit("</th></tr><tr><td rowspan='2'>"), F.col("s_nationkey").cast("string"), F.lit("</td><td>p"), F.col("s_suppkey").cast("string"),
        F.lit("<table><tr><td>inner</td></tr></table></td><td>"), (F.col("s_suppkey") * 7).cast("string"),
        F.lit("</td></tr><tr><td>x</td><td>y</td></tr></table><table><tr><td>not the first</td></tr></table>"),
    )
    return html.table_grid(s.select("s_suppkey", page.alias("html")), "html", ["s_suppkey"])


@query(
    "q11_first_player_load",
    f"""with {S.PLAYER_LOG} select "SEASON_ID", "Player_ID", "Game_ID", "GAME_DATE", "WL", "PTS", "LINE_NO", "TEAM",
  "OPPONENT", "HOME/AWAY", s_name as player_name from player_log left join supplier on s_suppkey = "Player_ID" and s_suppkey % 10 <> 3""",
)
def q11_first_load(spark, sf):
    """The first full load keeps every logged player; those not listed stay unnamed."""
    from workload.views import players

    listed = players(spark, sf).where(F.col("PERSON_ID") % 10 != 3)
    rows = ingest.shape_all_player_logs(log_payloads(player_logs(spark, sf)), LOG_COLUMNS, listed)
    return rows.select(
        "SEASON_ID", "Player_ID", "Game_ID", "GAME_DATE", "WL", "PTS", "LINE_NO", "TEAM", "OPPONENT", "`HOME/AWAY`", "player_name"
    )


@query("q11_restore_table", "select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def q11_restore(spark, sf):
    """A table written, backed up as CSV, damaged, and restored from the backup."""
    root = _folder(spark)
    rows = table(spark, sf, "supplier").select(*[f.name for f in SUPPLIER.fields])
    tables.write_table(rows, root, "general", "suppliers", "fail")
    tables.write_csv(rows, f"{root}/backup/suppliers")
    tables.write_table(rows.where(F.col("s_suppkey") % 2 == 0), root, "general", "suppliers", "replace")
    ingest.restore_table(tables.read_csv(spark, f"{root}/backup/suppliers", SUPPLIER), root, "general", "suppliers")
    return tables.read_table(spark, root, "general", "suppliers")


@query(
    "q11_season_mark",
    f"""with {S.TEAM_LOG} select 'before' as load, 1979 as season
union all select 'after', cast(max("SEASON_YEAR") as int) from team_log where "TEAM_ID" < 20""",
)
def q11_season_mark(spark, sf):
    """The season from which the next team-log load starts: before any load, then after a full one."""
    from hoopline.operators.ingest import latest_season
    from workload.views import team_logs

    root = _folder(spark)
    columns = T.StructType([T.StructField(c, T.LongType() if c == "TEAM_ID" else T.StringType()) for c in ("TEAM_ID", "GAME_ID", "MATCHUP")])
    empty = spark.createDataFrame([], "SEASON_YEAR int")
    before = latest_season(empty, "SEASON_YEAR").select(F.lit("before").alias("load"), F.col("season").cast("int"))
    logs = team_logs(spark, sf)
    names = ["TEAM_ID", "GAME_ID", "MATCHUP"]
    landed = logs.select(_result_sets(F.col("TEAM_ID"), [(names, [F.col(c) for c in names])]).alias("payload"), "SEASON_YEAR")
    teams = table(spark, sf, "nation").filter("n_nationkey < 20").select(F.col("n_nationkey").cast("bigint").alias("id"))
    path = ingest.ingest_team_logs(landed, columns, teams, ["TEAM_ID", "GAME_ID", "SEASON_YEAR"], root)
    after = latest_season(spark.read.parquet(path), "SEASON_YEAR").select(F.lit("after").alias("load"), F.col("season").cast("int"))
    return before.unionByName(after)

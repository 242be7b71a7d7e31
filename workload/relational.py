"""Joins, set operations, and incremental loading rules."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from hoopline.operators import ingest as I
from hoopline.operators import joins as J
from hoopline.operators import key_index as KI
from hoopline.operators.selection import members
from hoopline.plans import betting
from hoopline.plans.boxscore import MISC_METRICS, side_rows
from hoopline.session import staging_root
from workload import sql as S
from workload.registry import query
from workload.views import lines, player_logs, players, table, team_logs, team_misc

ALL_SEASONS = 0

@query(
    "j1_left_join_height",
    f"""with {S.PLAYER_LOG}, {S.PLAYERS} select "Player_ID" as "PLAYER_ID", "Game_ID" as "GAME_ID", "LINE_NO",
  "PTS" as "PLAYER_PTS", try_cast(split_part("HEIGHT", '-', 1) as double) * 12
    + try_cast(split_part("HEIGHT", '-', 2) as double) as "HEIGHT_INCHES"
from player_log l left join (select * from players where "PERSON_ID" % 10 <> 3) p on p."PERSON_ID" = l."Player_ID\"""",
)
def j1(spark, sf):
    known = players(spark, sf).filter(F.col("PERSON_ID") % 10 != 3)  # some logs have no player entry
    rows = betting.clean_player_logs(player_logs(spark, sf), known, keep=["LINE_NO"])
    return rows.select("PLAYER_ID", "GAME_ID", "LINE_NO", "PLAYER_PTS", "HEIGHT_INCHES")


@query(
    "j2_features_to_lines",
    f"""with {S.LINES}, scores as (select lpad(cast(l_orderkey as varchar), 10, '0') as game_id, game_date, home_id, away_id,
    count(*) as player_rows from played group by 1, 2, 3, 4)
select s.game_date as "GAME_DATE", 'T' || lpad(cast(home_id as varchar), 2, '0') as "HOME_TEAM",
  'T' || lpad(cast(away_id as varchar), 2, '0') as "AWAY_TEAM", s.game_id as "GAME_ID", player_rows, favorite as "FAVORITE",
  total as "GAME_TOTAL_PTS"
from scores s join lines l on l.game_id = s.game_id and cast(l.game_date as date) = s.game_date
  and l.home_team_abbrev = 'T' || lpad(cast(home_id as varchar), 2, '0')
  and l.visit_team_abbrev = 'T' || lpad(cast(away_id as varchar), 2, '0')""",
)
def j2(spark, sf):
    """Date and both teams, plus the game id because test teams may meet twice on a date."""
    rows = betting.clean_player_logs(player_logs(spark, sf), players(spark, sf))
    on = ["GAME_DATE", "HOME_TEAM", "AWAY_TEAM", "GAME_ID"]
    counts = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("player_rows"))
    keyed = betting.format_lines(lines(spark, sf), [F.col("game_id").alias("GAME_ID")])
    return counts.join(keyed, on, "inner").select(*on, "player_rows", "FAVORITE", "GAME_TOTAL_PTS")


@query(
    "j4_suffixed_join",
    """with f as (select o_custkey, count(*) as games, max(o_totalprice) as best from orders where o_orderstatus = 'F' group by 1),
o as (select o_custkey, count(*) as games, max(o_totalprice) as best from orders where o_orderstatus <> 'F' group by 1)
select o_custkey, f.games as "games_HOME", o.games as "games_AWAY", f.best as "best_HOME", o.best as "best_AWAY"
from f join o using (o_custkey)""",
)
def j4(spark, sf):
    orders = table(spark, sf, "orders")

    def side(rows):
        return rows.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("games"), F.max("o_totalprice").alias("best"))

    home, away = side(orders.filter("o_orderstatus = 'F'")), side(orders.filter("o_orderstatus <> 'F'"))
    return J.join_suffixed(home, away, ["o_custkey"], ("_HOME", "_AWAY"))


@query(
    "j6_renamed_keys",
    """select l_orderkey, l_linenumber, l_quantity, l_suppkey, s_acctbal from lineitem join supplier on l_suppkey = s_suppkey""",
)
def j6(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    return J.join_renamed(rows, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", ["s_suppkey", "s_name", "s_nationkey"])


@query(
    "p22_name_lookup",
    """select l_orderkey, l_linenumber, l_quantity, l_suppkey, s_name as player_name
from lineitem left join supplier on l_suppkey = s_suppkey""",
)
def p22(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_suppkey")
    return J.lookup_name(rows, table(spark, sf, "supplier"), "l_suppkey", "s_suppkey", "s_name", "player_name")


@query(
    "j9_semi_join",
    "select c_custkey, c_name from customer where exists (select 1 from orders where o_custkey = c_custkey and o_totalprice > 300000)",
)
def j9(spark, sf):
    large = table(spark, sf, "orders").filter(F.col("o_totalprice") > 300000)
    return members(table(spark, sf, "customer"), large, "c_custkey", "o_custkey").select("c_custkey", "c_name")


@query(
    "j11_players_by_active_season",
    f"""with {S.PLAYERS}, seasons as (select distinct cast(year(o_orderdate) as int) as season from orders)
select "PERSON_ID", season from players join seasons on season between "FROM_YEAR" and "TO_YEAR\"""",
)
def j11(spark, sf):
    seasons = table(spark, sf, "orders").select(F.year("o_orderdate").alias("season"))
    active = J.active_in_season(players(spark, sf), seasons, "FROM_YEAR", "TO_YEAR", "season")
    return active.select("PERSON_ID", "season")


@query(
    "j11_binned_range_join",
    f"""with {S.PLAYERS}, days as (select distinct o_orderdate as day from orders)
select "PERSON_ID", day from players join days
  on day between make_date(cast("FROM_YEAR" as int), 1, 1) and make_date(cast("TO_YEAR" as int), 12, 31)""",
)
def j11_binned(spark, sf):
    """Each player against every order date of the decades the player was active: pairs only, by bins."""
    p = players(spark, sf).select(
        "PERSON_ID",
        F.make_date(F.col("FROM_YEAR").cast("int"), F.lit(1), F.lit(1)).alias("first_day"),
        F.make_date(F.col("TO_YEAR").cast("int"), F.lit(12), F.lit(31)).alias("last_day"),
    )
    days = table(spark, sf, "orders").select(F.col("o_orderdate").alias("day")).distinct()
    return J.binned_range_join(days, p, "day", "first_day", "last_day").select("PERSON_ID", "day")


@query(
    "j3_three_way_join",
    f"""with {S.BOX} select tl.bare_id as game_id, tl."TEAM_ID" as team_id, tl."PTS" as pts, mm.paint_pts, am.pace
from team_log tl join misc mm on tl.bare_id = mm.game_id and tl."TEAM_ID" = mm.team_id
join advanced am on mm.game_id = am.game_id and mm.team_id = am.team_id""",
)
def j3(spark, sf):
    from hoopline.functions.text import strip_zeros
    from hoopline.plans.boxscore import ADVANCED_METRICS
    from workload.views import team_advanced

    logs = team_logs(spark, sf).select(
        strip_zeros("GAME_ID").alias("game_id"), F.col("TEAM_ID").alias("team_id"), F.col("PTS").alias("pts")
    )
    keys = ["game_id", "team_id"]
    misc = side_rows(team_misc(spark, sf), MISC_METRICS, ALL_SEASONS).select(*keys, "paint_pts")
    advanced = side_rows(team_advanced(spark, sf), ADVANCED_METRICS, ALL_SEASONS).select(*keys, "pace")
    return logs.join(misc, keys).join(advanced, keys)


@query("u1_union_of_sides", f"with {S.BOX} select * exclude (season) from misc")
def u1(spark, sf):
    return side_rows(team_misc(spark, sf), MISC_METRICS, ALL_SEASONS)


@query(
    "u2_union_all",
    """select o_custkey as key, o_totalprice as amount, 'order' as kind from orders
union all select c_custkey, c_acctbal, 'balance' from customer""",
)
def u2(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("amount"), F.lit("order").alias("kind")
    )
    balances = table(spark, sf, "customer").select(
        F.lit("balance").alias("kind"), F.col("c_acctbal").alias("amount"), F.col("c_custkey").alias("key")
    )
    return orders.unionByName(balances)


@query(
    "i1_high_water_mark",
    """select cast(max(o_orderdate) as date) + 1 as next_date, strftime(max(o_orderdate) + interval 1 day, '%m/%d/%Y')
as next_date_text from orders where o_orderstatus = 'F'""",
)
def i1(spark, sf):
    loaded = table(spark, sf, "orders").filter("o_orderstatus = 'F'").withColumn("day", F.col("o_orderdate").cast("date"))
    return I.next_load_date(loaded, "day")


@query(
    "i1_rows_since_mark",
    """select l_orderkey, l_linenumber, l_quantity from lineitem where cast(l_shipdate as date) >
  (select max(cast(o_orderdate as date)) from orders where o_totalprice > 400000)""",
)
def i1_since(spark, sf):
    loaded = table(spark, sf, "orders").filter("o_totalprice > 400000").withColumn("day", F.col("o_orderdate").cast("date"))
    rows = table(spark, sf, "lineitem").withColumn("day", F.col("l_shipdate").cast("date"))
    return I.since_mark(rows, "day", loaded, "day").select("l_orderkey", "l_linenumber", "l_quantity")


@query(
    "i2_new_keys",
    """select distinct ltrim(cast(l_orderkey as varchar), '0') as game_id from lineitem
where ltrim(cast(l_orderkey as varchar), '0') not in (select ltrim(cast(o_orderkey as varchar), '0') from orders where o_orderstatus = 'F')""",
)
def i2(spark, sf):
    source = table(spark, sf, "lineitem").select(F.lpad(F.col("l_orderkey").cast("string"), 10, "0").alias("game_id"))
    target = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("gameId"))
    return I.new_keys(source, target, "game_id", "gameId")



@query(
    "i2_new_keys_indexed",
    """select distinct ltrim(cast(l_orderkey as varchar), '0') as game_id from lineitem
where ltrim(cast(l_orderkey as varchar), '0') not in (select ltrim(cast(o_orderkey as varchar), '0') from orders where o_orderstatus = 'F')""",
)
def i2_indexed(spark, sf):
    """i2 against the stored table through its key index: only files that may hold a wanted key are read."""
    source = table(spark, sf, "lineitem").select(F.lpad(F.col("l_orderkey").cast("string"), 10, "0").alias("game_id"))
    target = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("gameId"))
    path = f"{staging_root(spark)}/keyed-{uuid.uuid4().hex}"
    files = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    KI.store_with_key_index(target, path, "gameId", files)
    return KI.new_keys_indexed(source, path, "game_id", "gameId").rows

@query(
    "i3_latest_season",
    """select 'loaded' as target, cast(max(year(o_orderdate)) as int) as season from orders
union all select 'empty', 1979""",
)
def i3(spark, sf):
    loaded = table(spark, sf, "orders").select(F.year("o_orderdate").alias("season"))
    found = I.latest_season(loaded, "season").select(F.lit("loaded").alias("target"), "season")
    nothing = I.latest_season(loaded.filter("season > 9999"), "season").select(F.lit("empty").alias("target"), "season")
    return found.unionByName(nothing)


@query("i5_exact_duplicates", "select distinct l_orderkey, l_linenumber, l_returnflag, l_linestatus from lineitem")
def i5(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus").dropDuplicates()

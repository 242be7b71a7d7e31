"""Scalar cleaning expressions and filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hoopline.functions import numeric as N
from hoopline.functions import text as T
from hoopline.operators import ingest as I
from hoopline.operators.selection import members, minimum_history
from hoopline.plans.betting import clean_player_logs
from hoopline.plans.lines import coverage_by_side, todays_lines, with_underdog
from workload import sql as S
from workload.registry import query
from workload.views import lines, player_logs, players, raw_lines, table, team_logs


def _matchups(spark, sf):
    home = F.concat(F.lit("T"), (F.col("o_custkey") % 25).cast("string"))
    away = F.concat(F.lit("T"), ((F.col("o_custkey") + 1 + F.col("o_orderkey") % 24) % 25).cast("string"))
    word = F.when(F.col("o_orderkey") % 2 == 0, "  @ ").otherwise(" vs. ")
    return table(spark, sf, "orders").select("o_orderkey", F.concat(F.lit(" "), home, word, away).alias("MATCHUP"))


@query(
    "p1_matchup_parse",
    """with m as (select o_orderkey, regexp_split_to_array(trim(' T' || (o_custkey % 25) ||
  case when o_orderkey % 2 = 0 then '  @ ' else ' vs. ' end || 'T' || ((o_custkey + 1 + o_orderkey % 24) % 25)),
  '\\s+') as w from orders)
select o_orderkey, w[1] as "TEAM", w[len(w)] as "OPPONENT",
  case when w[2] = '@' then 'AWAY' else 'HOME' end as "HOME/AWAY" from m""",
)
def p1(spark, sf):
    return T.with_matchup(_matchups(spark, sf)).drop("MATCHUP")


@query(
    "p2_mixed_dates",
    """select o_orderkey, case when o_orderkey % 101 = 0 then null else cast(o_orderdate as date) end as game_date
from orders""",
)
def p2(spark, sf):
    day = F.col("o_orderdate")
    text = (
        F.when(F.col("o_orderkey") % 101 == 0, "not a date")
        .when(F.col("o_orderkey") % 2 == 0, F.upper(F.date_format(day, "MMM d, yyyy")))
        .when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(F.col("o_orderkey") % 5 == 0, F.date_format(day, "yyyy-MM-dd HH:mm"))
        .otherwise(F.date_format(day, "yyyy-M-d"))
    )
    return table(spark, sf, "orders").select("o_orderkey", T.mixed_date(text).alias("game_date"))


@query(
    "p3_season_year",
    "select o_orderkey, cast(right('2' || cast(year(o_orderdate) as varchar), 4) as int) as season from orders",
)
def p3(spark, sf):
    season_id = F.concat(F.lit("2"), F.year("o_orderdate").cast("string"))
    return table(spark, sf, "orders").select("o_orderkey", T.season_year(season_id).alias("season"))


@query(
    "p4_text_to_date",
    "select l_orderkey, l_linenumber, l_quantity, cast(strftime(l_shipdate, '%Y-%m-%d') as date) as day from lineitem",
)
def p4(spark, sf):
    text = F.date_format("l_shipdate", "yyyy-MM-dd")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", T.iso_date(text).alias("day")
    )


@query(
    "p5_height_inches",
    f"""with {S.PLAYERS} select "PERSON_ID", try_cast(split_part("HEIGHT", '-', 1) as double) * 12
  + try_cast(split_part("HEIGHT", '-', 2) as double) as inches from players""",
)
def p5(spark, sf):
    return players(spark, sf).select("PERSON_ID", T.height_inches("HEIGHT").alias("inches"))


@query(
    "p6_strip_zeros",
    "select o_orderkey, ltrim(lpad(cast(o_orderkey as varchar), 10, '0'), '0') as bare_id from orders",
)
def p6(spark, sf):
    padded = F.lpad(F.col("o_orderkey").cast("string"), 10, "0")
    return table(spark, sf, "orders").select("o_orderkey", T.strip_zeros(padded).alias("bare_id"))


@query("p7_snake_case", "select event_id, user_id, event_type, value from events")
def p7(spark, sf):
    camel = table(spark, sf, "events").select(
        F.col("event_id").alias("eventId"), F.col("user_id").alias("userId"),
        F.col("event_type").alias("eventType"), "value",
    )
    return T.snake_columns(camel)


@query("p8_drop_ranks", "select p_partkey as partkey, p_size as size, p_retailprice as retail_price from part")
def p8(spark, sf):
    upper = table(spark, sf, "part").select(
        F.col("p_partkey").alias("PARTKEY"), F.col("p_size").alias("SIZE"),
        F.lit(1).alias("SIZE_RANK"), F.lit(2).alias("RETAIL_PRICE_RANK"),
        F.col("p_retailprice").alias("RETAIL_PRICE"),
    )
    return T.drop_ranks(upper)


@query(
    "p9_id_list",
    """select l_orderkey, l_linenumber, l_quantity, cast(l_partkey as varchar) as first_id,
  cast(l_suppkey as varchar) as second_id, 2 as ids from lineitem""",
)
def p9(spark, sf):
    text = F.concat(F.lit("-"), F.col("l_partkey").cast("string"), F.lit("-"), F.col("l_suppkey").cast("string"), F.lit("-"))
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", T.id_list(text).alias("group_id"))
    return rows.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("group_id")[0].alias("first_id"),
        F.col("group_id")[1].alias("second_id"), F.size("group_id").alias("ids"),
    )


@query(
    "p10_rename_and_prefix",
    'select s_suppkey as "HOME_TEAM_ID", s_name as "HOME_TEAM", s_acctbal as "HOME_s_acctbal" from supplier',
)
def p10(spark, sf):
    rows = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return T.rename(rows, {"s_suppkey": "TEAM_ID", "s_name": "TEAM"}, "HOME_")


@query(
    "p11_blank_to_null",
    """select c_custkey, case when c_custkey % 3 = 2 then c_mktsegment end as segment from customer""",
)
def p11(spark, sf):
    text = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, " \t ").otherwise(F.col("c_mktsegment"))
    rows = table(spark, sf, "customer").select("c_custkey", text.alias("segment"))
    return T.blank_to_null(rows, whitespace=True)


@query(
    "p11_exact_blank_to_null",
    """select c_custkey, case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then ' ' else c_mktsegment end
as segment from customer""",
)
def p11_exact(spark, sf):
    text = F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, " ").otherwise(F.col("c_mktsegment"))
    return T.blank_to_null(table(spark, sf, "customer").select("c_custkey", text.alias("segment")))


@query(
    "p12_drop_null_rows",
    f"""with {S.PLAYERS} select "PERSON_ID", "DRAFT_ROUND", "DRAFT_NUMBER" from players
where "DRAFT_ROUND" is not null and "DRAFT_NUMBER" is not null""",
)
def p12(spark, sf):
    return N.drop_null_rows(players(spark, sf).select("PERSON_ID", "DRAFT_ROUND", "DRAFT_NUMBER"))


@query(
    "p12_drop_null_subset",
    f"""with {S.PLAYERS} select "PERSON_ID", "DRAFT_ROUND", nullif("HEIGHT", '') as height from players
where nullif("HEIGHT", '') is not null""",
)
def p12_subset(spark, sf):
    rows = players(spark, sf).select("PERSON_ID", "DRAFT_ROUND", F.nullif("HEIGHT", F.lit("")).alias("height"))
    return N.drop_null_rows(rows, ["height"])


@query(
    "p13_mean_fill",
    """with gaps as (select event_id, case when user_id % 5 <> 0 then value end as value,
  case when user_id % 7 <> 0 then cast(user_id as double) end as weight from events)
select event_id, round(coalesce(value, avg(value) over ()), 6) as value,
  round(coalesce(weight, avg(weight) over ()), 6) as weight from gaps""",
)
def p13(spark, sf):
    user = F.col("user_id")
    gaps = table(spark, sf, "events").select(
        "event_id", F.when(user % 5 != 0, F.col("value")).alias("value"),
        F.when(user % 7 != 0, user).alias("weight"),
    )
    filled = N.fill_with_means(gaps, ["value", "weight"])
    return filled.withColumns({c: F.round(c, 6) for c in ("value", "weight")})


@query(
    "p14_win_flags",
    f"""with {S.PLAYER_LOG} select "Player_ID" as "PLAYER_ID", "Game_ID" as "GAME_ID", "LINE_NO", "PTS" as "PLAYER_PTS",
  case when "WL" = 'W' then 1 else 0 end as "W", case when "WL" = 'L' then 1 else 0 end as "L",
  home_team as "HOME_TEAM", away_team as "AWAY_TEAM" from player_log""",
)
def p14(spark, sf):
    rows = clean_player_logs(player_logs(spark, sf), players(spark, sf), keep=["LINE_NO"])
    return rows.select("PLAYER_ID", "GAME_ID", "LINE_NO", "PLAYER_PTS", "W", "L", "HOME_TEAM", "AWAY_TEAM")


@query("p15_underdog", f"with {S.LINES} select game_id, favorite, underdog from lines")
def p15(spark, sf):
    return with_underdog(raw_lines(spark, sf)).select("game_id", "favorite", "underdog")


def todays_feed(spark, sf):
    """Both sides of every line as separate records, the spread as text signed for that side."""
    key = F.col("game_id").cast("int")

    def side(me, other, place, sign):
        spread = F.when(key % 11 != 0, (F.col("line") * sign).cast("string"))
        return F.struct(
            F.col(f"{me}_team_abbrev").alias("abbr"), F.col(f"{other}_team_abbrev").alias("oppAbbr"),
            F.lit(place).alias("homeAway"), spread.alias("hardrock_spread"),
            F.col("total").cast("string").alias("hardrock_ou"),
        )

    return lines(spark, sf).select(
        F.col("game_id").alias("gameID"), F.col("game_date").alias("gameDate"),
        F.date_format(F.col("game_date").cast("date"), "EEEE").alias("gameDay"),
        F.inline(F.array(side("home", "visit", "home", 1), side("visit", "home", "away", -1))),
    )


TODAY_SQL = f"""with {S.LINES} select game_id as "gameID", game_date as "gameDate", home_team_abbrev as "homeTeam",
  visit_team_abbrev as "awayTeam", cast(total as varchar) as "OVER_UNDER", line as "LINE"
from lines where cast(game_id as bigint) % 11 <> 0"""


@query("p16_line_signed_from_home", TODAY_SQL)
def p16(spark, sf):
    return todays_lines(todays_feed(spark, sf))


@query(
    "p17_derived_columns",
    f"""with {S.TEAM_LOG} select "GAME_ID", "TEAM", "FGM" - "FG3M" as fg2m, "FGA" - "FG3A" as fg2a,
  "PTS" - "PLUS_MINUS" as opp_pts from team_log""",
)
def p17(spark, sf):
    rows = team_logs(spark, sf).select(
        "GAME_ID", "TEAM", (F.col("PTS") - F.col("PLUS_MINUS")).alias("opp_pts"),
        *[F.col(c).alias(c.lower()) for c in ("FGM", "FGA", "FG3M", "FG3A")],
    )
    return N.two_point_columns(rows).select("GAME_ID", "TEAM", "fg2m", "fg2a", "opp_pts")


@query(
    "p18_guarded_ratio",
    """select p_partkey, case when p_partkey % 5 <> 0 then p_size / (p_partkey % 5) end as ratio,
  case when p_partkey % 5 <> 0 then p_size / (p_partkey % 5) * 100 end as pct from part""",
)
def p18(spark, sf):
    bottom = F.col("p_partkey") % 5
    return table(spark, sf, "part").select(
        "p_partkey", N.ratio("p_size", bottom).alias("ratio"), N.percentage("p_size", bottom).alias("pct")
    )


@query(
    "p19_rounding",
    """select l_orderkey, l_linenumber, l_quantity, round(l_extendedprice / 7, 2) as two,
  round(l_extendedprice / 7, 4) as four, round(l_extendedprice / 7, 5) as five from lineitem""",
)
def p19(spark, sf):
    x = F.col("l_extendedprice") / 7
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", F.round(x, 2).alias("two"), F.round(x, 4).alias("four"),
        F.round(x, 5).alias("five"),
    )


@query("p20_stamp_constants", "select o_orderkey, 2007 as season, 3 as period from orders")
def p20(spark, sf):
    return N.stamp(table(spark, sf, "orders").select("o_orderkey"), season=2007, period=3)


@query(
    "p21_draft_numbers",
    f"""with {S.PLAYERS} select "PERSON_ID", case when "DRAFT_YEAR" = 'Undrafted' then 0 else cast("DRAFT_YEAR" as int) end
  as draft_year, coalesce(cast("DRAFT_ROUND" as int), 0) as draft_round from players""",
)
def p21(spark, sf):
    return players(spark, sf).select(
        "PERSON_ID", T.draft_number("DRAFT_YEAR").alias("draft_year"), T.draft_number("DRAFT_ROUND").alias("draft_round")
    )


AS_OF = dt.date(2001, 6, 15)


@query(
    "p25_second_night_from_snapshot",
    f"""with {S.LINES}, last_games as (select t.team,
    max(case when t.team = home_team_abbrev then game_date end) as last_home,
    max(case when t.team = visit_team_abbrev then game_date end) as last_away
  from lines, lateral (values (home_team_abbrev), (visit_team_abbrev)) t(team)
  where game_date < '2001-06-15' group by 1)
select team, case when cast(last_home as date) = date '2001-06-14' or cast(last_away as date) = date '2001-06-14'
  then 1 else 0 end as second_night from last_games""",
)
def p25(spark, sf):
    played = lines(spark, sf).filter(F.col("game_date") < str(AS_OF))
    sides = played.select(
        "game_date",
        F.inline(F.array(
            F.struct(F.col("home_team_abbrev").alias("team"), F.lit("home").alias("place")),
            F.struct(F.col("visit_team_abbrev").alias("team"), F.lit("away").alias("place")),
        )),
    )
    last = sides.groupBy("team").agg(
        *[F.max(F.when(F.col("place") == p, F.col("game_date"))).alias(f"last_{p}") for p in ("home", "away")]
    )
    return last.select("team", N.second_night(["last_home", "last_away"], F.lit(AS_OF)).alias("second_night"))


@query(
    "f1_validity_range",
    f"""with {S.PLAYERS} select "PERSON_ID", "FROM_YEAR", "TO_YEAR" from players where 1997 between "FROM_YEAR" and "TO_YEAR\"""",
)
def f1(spark, sf):
    rows = players(spark, sf).select("PERSON_ID", "FROM_YEAR", "TO_YEAR")
    return rows.filter((F.col("FROM_YEAR") <= 1997) & (F.col("TO_YEAR") >= 1997))


@query(
    "f2_membership",
    """select l_orderkey, l_linenumber, l_quantity from lineitem where l_suppkey in
  (select s_suppkey from supplier where s_acctbal < 0)""",
)
def f2(spark, sf):
    listed = table(spark, sf, "supplier").filter(F.col("s_acctbal") < 0)
    return members(table(spark, sf, "lineitem"), listed, "l_suppkey", "s_suppkey").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query(
    "f3_minimum_history",
    """with played as (select o_custkey, count(case when o_orderstatus = 'F' then 1 end) as "HOME_TEAM_GAMES_PLAYED",
  count(case when o_orderstatus <> 'F' then 1 end) as "AWAY_TEAM_GAMES_PLAYED" from orders group by 1)
select * from played where "HOME_TEAM_GAMES_PLAYED" >= 5 and "AWAY_TEAM_GAMES_PLAYED" >= 5""",
)
def f3(spark, sf):
    home = F.col("o_orderstatus") == "F"
    played = table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.count(F.when(home, 1)).alias("HOME_TEAM_GAMES_PLAYED"),
        F.count(F.when(~home, 1)).alias("AWAY_TEAM_GAMES_PLAYED"),
    )
    return minimum_history(played, ["HOME_TEAM_GAMES_PLAYED", "AWAY_TEAM_GAMES_PLAYED"])


@query(
    "f4_season_threshold",
    """select o_orderkey, cast(year(o_orderdate) as int) as season from orders where year(o_orderdate) >= 1996
  and cast((1 + o_orderkey % 4) || '' || year(o_orderdate) as int) >= 21996""",
)
def f4(spark, sf):
    season_id = F.concat((1 + F.col("o_orderkey") % 4).cast("string"), F.year("o_orderdate").cast("string"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"), season_id.alias("id"))
    return rows.filter(I.season_filter("season", 1996) & I.season_id_filter("id")).drop("id")


@query(
    "f5_favorite_at_home",
    f"with {S.LINES} select game_id, favorite, spread from lines where favorite = home_team_abbrev",
)
def f5(spark, sf):
    return lines(spark, sf).filter(F.col("favorite") == F.col("home_team_abbrev")).select("game_id", "favorite", "spread")


@query(
    "f6_equality_and_substring",
    "select o_orderkey, o_orderpriority from orders where o_orderstatus = 'F' and contains(o_orderpriority, 'URGENT')",
)
def f6(spark, sf):
    rows = table(spark, sf, "orders").filter(
        (F.col("o_orderstatus") == "F") & F.col("o_orderpriority").contains("URGENT")
    )
    return rows.select("o_orderkey", "o_orderpriority")


@query(
    "f7_either_side",
    f"""with {S.LINES}, teams as (select distinct home_team_abbrev as team from lines
  union select distinct visit_team_abbrev from lines)
select t.team, count(*) as total_games from teams t join lines g
  on (g.visit_team_abbrev = t.team or g.home_team_abbrev = t.team) and (g.favorite = t.team or g.underdog = t.team)
group by 1""",
)
def f7(spark, sf):
    return coverage_by_side(lines(spark, sf)).groupBy("team").agg(F.sum("total_games").alias("total_games"))

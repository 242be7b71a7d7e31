"""Line reports, their aggregates, and the snapshots and lineups used for predictions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from hoopline.functions.numeric import total
from hoopline.operators import ingest as I, models as M
from hoopline.operators.selection import sorted_desc, sorted_report, top_k
from hoopline.plans import betting, lines as L, lineups, predictions as P, snapshots
from hoopline.session import stage
from hoopline.sources.html import injury_table
from hoopline.sources.payloads import lineup_players
from workload import sql as S
from workload.cleaning import TODAY_SQL, todays_feed
from workload.registry import query
from workload.views import TIES, _played, lines, player_logs, players, table, team_logs

W = f"with {S.LINES}"


def _roles_sql(role, alias_covered, alias_games, alias_pct):
    return f"""select {role} as team, cast(sum({role}_covered) as bigint) as {alias_covered},
    count(*) as {alias_games}, sum({role}_covered) / count(*) * 100 as {alias_pct} from lines group by 1"""


@query("a3_count_per_key", f"{W} select favorite, count(*) as games from lines group by 1")
def a3(spark, sf):
    return lines(spark, sf).groupBy("favorite").agg(F.count(F.lit(1)).alias("games"))


@query(
    "a4_role_counts",
    f"""{W} select 'favorite' as role, * from ({_roles_sql("favorite", "covered", "games", "hit_percentage")})
union all select 'underdog', * from ({_roles_sql("underdog", "covered", "games", "hit_percentage")})""",
)
def a4(spark, sf):
    by_role = [
        L.role_counts(lines(spark, sf), role).select(F.lit(role).alias("role"), "*")
        for role in ("favorite", "underdog")
    ]
    return by_role[0].unionByName(by_role[1])


_SUMMARY = f"""{W}, f as ({_roles_sql("favorite", "covered_as_favorite", "total_times_favorite", "fav_hit_percentage")}),
d as ({_roles_sql("underdog", "covered_as_dog", "total_times_underdog", "dog_hit_percentage")})
select team, covered_as_favorite, total_times_favorite, fav_hit_percentage, covered_as_dog, total_times_underdog,
  dog_hit_percentage, (covered_as_favorite + covered_as_dog) / (total_times_favorite + total_times_underdog) * 100
  as overall_hit_percentage from f join d using (team)"""


@query("a5_coverage_summary", _SUMMARY)
def a5(spark, sf):
    return L.coverage_summary(lines(spark, sf))


@query("j5_favorite_with_underdog", _SUMMARY)
def j5(spark, sf):
    """The same report from two aggregates joined on team."""
    names = {
        "favorite": ("covered_as_favorite", "total_times_favorite", "fav_hit_percentage"),
        "underdog": ("covered_as_dog", "total_times_underdog", "dog_hit_percentage"),
    }
    sides = [
        L.role_counts(lines(spark, sf), role).toDF("team", *names[role]) for role in ("favorite", "underdog")
    ]
    both = sides[0].join(sides[1], "team")
    covered = F.col("covered_as_favorite") + F.col("covered_as_dog")
    games = F.col("total_times_favorite") + F.col("total_times_underdog")
    return both.withColumn("overall_hit_percentage", L.percentage(covered, games))


def _split_sql(role):
    def side(place, abbrev):
        return f"""(select {role} as team, cast(sum({role}_covered) as bigint) as covered_as_{role}_{place},
    count(*) as total_times_{role}_{place},
    sum({role}_covered) / count(*) * 100 as hit_percentage_as_{role}_{place}
    from lines where {role} = {abbrev} group by 1)"""

    return f"{W} select * from {side('away', 'visit_team_abbrev')} join {side('home', 'home_team_abbrev')} using (team)"


@query("a6_favorite_split", _split_sql("favorite"))
def a6_favorite(spark, sf):
    return L.coverage_splits(lines(spark, sf), "favorite")


@query("a6_underdog_split", _split_sql("underdog"))
def a6_underdog(spark, sf):
    return L.coverage_splits(lines(spark, sf), "underdog")


def _ou_side(me, other, place):
    return f"""(select {me}_team_abbrev as team, avg({me}_team_score) as ppg_{place}, avg({other}_team_score) as opp_ppg_{place},
  avg({me}_team_score) + avg({other}_team_score) as combined_ppg_{place},
  cast(sum(over_hit) as bigint) as over_hit_{place}, avg(over_hit) as over_hit_{place}_percentage
  from lines group by 1)"""


@query(
    "a7_over_under_splits",
    f"{W} select * from {_ou_side('home', 'visit', 'home')} join {_ou_side('visit', 'home', 'away')} using (team)",
)
def a7(spark, sf):
    return L.over_under_splits(lines(spark, sf))


_BY_SIDE = f"""{W}, sides as (
  select visit_team_abbrev as team, 'away' as home_away, * from lines
  union all select home_team_abbrev, 'home', * from lines where home_team_abbrev <> visit_team_abbrev),
grouped as (
  select team, home_away, case when favorite = team then 'favorite' else 'underdog' end as fav_dog,
    case when (favorite_covered = 1) = (favorite = team) then 'covered' else 'failed' end as result,
    round(avg(spread), 2) as average_spread, round(stddev_samp(spread), 2) as std_spread, count(*) as total_games
  from sides where favorite = team or underdog = team group by 1, 2, 3, 4)
select *, case when fav_dog = 'underdog' then average_spread - std_spread else average_spread + std_spread end
  as "1_std_away" from grouped"""


@query("a8_coverage_by_side", _BY_SIDE)
def a8(spark, sf):
    return L.coverage_by_side(lines(spark, sf))


@query("q8_coverage_of_listed_teams", f"select * from ({_BY_SIDE}) where team in ('T01', 'T07', 'T24')")
def q8(spark, sf):
    listed = spark.createDataFrame([("T01",), ("T07",), ("T24",), ("T99",)], "team string")
    return L.coverage_by_side(lines(spark, sf), listed)


@query(
    "q7_line_reports",
    f"""select 'coverage' as report, team, overall_hit_percentage as metric from ({_SUMMARY})
union all select 'favorites', team, hit_percentage_as_favorite_home from ({_split_sql("favorite")})
union all select 'underdogs', team, hit_percentage_as_underdog_home from ({_split_sql("underdog")})
union all select 'over_under', team, over_hit_away_percentage from
  ({W} select * from {_ou_side('home', 'visit', 'home')} join {_ou_side('visit', 'home', 'away')} using (team))""",
)
def q7(spark, sf):
    reports = L.LineReports(lines(spark, sf), todays_feed(spark, sf))
    picked = {
        "coverage": "overall_hit_percentage",
        "favorites": "hit_percentage_as_favorite_home",
        "underdogs": "hit_percentage_as_underdog_home",
        "over_under": "over_hit_away_percentage",
    }
    frames = [
        reports.sorted(name, metric).select(F.lit(name).alias("report"), "team", F.col(metric).alias("metric"))
        for name, metric in picked.items()
    ]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@query("q5_todays_lines", TODAY_SQL)
def q5(spark, sf):
    return L.todays_lines(todays_feed(spark, sf))


_SNAP_ORDER = '"GAME_DATE", "Game_ID", "LINE_NO", "PTS"'
_SNAP_DESC = '"GAME_DATE" desc, "Game_ID" desc, "LINE_NO" desc, "PTS" desc'


def _snapshot_sql(ids):
    """``ids`` is a query giving personId."""
    return f"""with {S.PLAYER_LOG}, {S.PLAYERS}, form as (
  select p."Player_ID", player_name, "GAME_DATE", h."TEAM_ID", season as "SEASON_YEAR",
    round(avg("PTS") over (w rows between 2 preceding and current row), 4) as "LAST_3_PPG",
    round(stddev_samp("PTS") over (w rows between 2 preceding and current row), 4) as "LAST_3_PPG_STDDEV",
    round(avg("PTS") over (w rows between unbounded preceding and current row), 4) as "SEASON_PPG",
    round(stddev_samp("PTS") over (w rows between unbounded preceding and current row), 4) as "SEASON_PPG_STDDEV",
    try_cast(split_part("HEIGHT", '-', 1) as double) * 12 + try_cast(split_part("HEIGHT", '-', 2) as double) as "HEIGHT_INCHES",
    row_number() over (partition by p."Player_ID" order by {_SNAP_DESC}) as rn
  from player_log p left join players h on h."PERSON_ID" = p."Player_ID"
  where p."Player_ID" in ({ids})
  window w as (partition by season, player_name, p."Player_ID" order by {_SNAP_ORDER}))
select * exclude (rn) from form where rn = 1"""


Q2_SQL = _snapshot_sql("select s_suppkey from supplier where s_acctbal > 0")


@query("q2_active_player_snapshot", Q2_SQL)
def q2(spark, sf):
    ids = table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("personId"))
    return snapshots.active_player_snapshot(player_logs(spark, sf), players(spark, sf), ids, 3, TIES)


def _team_form_sql(place):
    where = f"where \"HOME/AWAY\" = '{place}'" if place else ""
    return f"""(select "GAME_DATE" as "LAST_GAME_DATE", "TEAM_ID", "TEAM", "SEASON_PPG", "LAST_3_PPG", "SEASON_OPP_PPG", "LAST_3_OPP_PPG"
  from (select *, round(avg("PTS") over (w rows between unbounded preceding and current row), 4) as "SEASON_PPG",
      round(avg("PTS") over (w rows between 2 preceding and current row), 4) as "LAST_3_PPG",
      round(avg("PTS" - "PLUS_MINUS") over (w rows between unbounded preceding and current row), 4) as "SEASON_OPP_PPG",
      round(avg("PTS" - "PLUS_MINUS") over (w rows between 2 preceding and current row), 4) as "LAST_3_OPP_PPG",
      row_number() over (partition by "TEAM_ID" order by "GAME_DATE" desc, "GAME_ID" desc) as rn
    from team_log {where} window w as (partition by "SEASON_YEAR", "TEAM" order by "GAME_DATE", "GAME_ID"))
  where rn = 1)"""


Q3_SQL = f"""with {S.TEAM_LOG}
select h."TEAM_ID", h."TEAM", {", ".join(f'{a}."{c}" as "{c}_{p}"' for c in
  ("LAST_GAME_DATE", "SEASON_PPG", "LAST_3_PPG", "SEASON_OPP_PPG", "LAST_3_OPP_PPG")
  for a, p in (("h", "HOME"), ("a", "AWAY")))}, t."SEASON_OPP_PPG", t."LAST_3_OPP_PPG"
from {_team_form_sql("HOME")} h join {_team_form_sql("AWAY")} a on a."TEAM" = h."TEAM"
join {_team_form_sql("")} t on t."TEAM_ID" = h."TEAM_ID\""""


@query("q3_team_snapshot", Q3_SQL)
def q3(spark, sf):
    """Team logs exist as a stored table in use."""
    return snapshots.team_snapshot(team_logs(spark, sf), 3, ["GAME_ID"])


@query(
    "a12_max_over_snapshot",
    f"""with {S.TEAM_LOG} select max("LAST_GAME_DATE") as last_game_date, "TEAM_ID", "TEAM" from
  {_team_form_sql("HOME")} group by 2, 3""",
)
def a12(spark, sf):
    snapshot = snapshots.team_snapshot(team_logs(spark, sf), 3, ["GAME_ID"])
    return snapshot.groupBy("TEAM_ID", "TEAM").agg(F.max("LAST_GAME_DATE_HOME").alias("last_game_date"))


def lineup_payloads(spark, sf):
    """One daily-lineup document per game with every player of each side."""
    p = _played(spark, sf)
    sides = {"home": F.col("at_home"), "away": ~F.col("at_home")}
    listed = [F.sort_array(F.collect_set(F.when(here, F.col("l_suppkey")))).alias(side) for side, here in sides.items()]
    games = p.groupBy("l_orderkey", "home_id", "away_id").agg(*listed)

    def team(side):
        def player(who):
            number = who.cast("string")
            status = F.when(who % 9 == 0, "Inactive").otherwise("Active")
            return F.struct(
                who.alias("personId"), F.lit("Player").alias("firstName"), number.alias("lastName"),
                F.concat(F.lit("Player "), number).alias("playerName"), F.lit("Expected").alias("lineupStatus"),
                F.lit("G").alias("position"), status.alias("rosterStatus"),
            )

        return F.struct(
            F.col(f"{side}_id").alias("teamId"),
            F.concat(F.lit("T"), F.lpad(F.col(f"{side}_id").cast("string"), 2, "0")).alias("teamAbbreviation"),
            F.transform(side, player).alias("players"),
        )

    game = F.struct(
        F.col("l_orderkey").cast("string").alias("gameId"), team("home").alias("homeTeam"), team("away").alias("awayTeam")
    )
    return games.select(F.to_json(F.struct(F.array(game).alias("games"))).alias("payload"))


_LINEUP_SQL = S.PLAYED + """, listed as (
  select distinct l_orderkey, case when at_home then 'home' else 'away' end as side,
    case when at_home then home_id else away_id end as team_id, l_suppkey as person
  from played),
lineup as (select cast(l_orderkey as varchar) as "gameId", team_id as "teamId",
    'T' || lpad(cast(team_id as varchar), 2, '0') as "teamAbbreviation", person as "personId", 'Player' as "firstName",
    cast(person as varchar) as "lastName", 'Player ' || cast(person as varchar) as "playerName",
    'Active' as "rosterStatus", side as home_away
  from listed where person % 9 <> 0)"""


@query("s8_lineup_players", f"with {_LINEUP_SQL} select * from lineup")
def s8(spark, sf):
    return lineup_players(lineup_payloads(spark, sf), "payload")


def injury_pages(spark, sf):
    """One injury page per supplier, some without a name and some without a description."""
    s = F.col("s_suppkey")
    status = F.when(s % 4 == 0, "Out - knee").when(s % 4 == 1, "Out For Season - ankle").when(s % 4 == 2, "Day To Day - rest").otherwise("Questionable")
    name = F.when(s % 10 == 8, "").otherwise(F.concat(F.lit("Player "), s.cast("string")))
    team, name = F.col("s_nationkey").cast("string"), F.replace(name, F.lit(" "), F.when(s % 3 == 0, "&#32;").otherwise("&#x20;"))
    usual = F.concat(
        F.lit('<table><tr><th>Player</th><th>Team</th><th>Update</th><th>Description</th></tr><tr><th scope="row"><a href="#">'),
        name, F.lit("</a></th><td>Team "), team, F.lit("</td><td>Mon</td>\n<td>"), status, F.lit("</td></tr></table>"),
    )
    # upper-case tags and another order of the columns
    other = F.concat(
        F.lit("<TABLE><TR><TH>Team</TH><TH>DESCRIPTION</TH><TH>Player</TH><TH>Update</TH></TR>\n<TR><TD>Team "), team,
        F.lit("</TD><TD>"), status, F.lit("</TD><TD>"), name, F.lit("</TD><TD>Mon</TD></TR></TABLE>"),
    )
    more = F.lit("<table><tr><th>Player</th></tr><tr><td>Player 1</td></tr></table>")
    page = F.concat(F.lit("<html>"), F.when(s % 7 == 0, other).otherwise(usual), more, F.lit("</html>"))
    return table(spark, sf, "supplier").select("s_suppkey", page.alias("html"))


_INJURY_SQL = """injuries as (select s_suppkey,
  case when s_suppkey % 10 = 8 then '' else 'Player ' || cast(s_suppkey as varchar) end as "Player",
  'Team ' || cast(s_nationkey as varchar) as "Team", 'Mon' as "Update",
  ['Out', 'Out For Season', 'Day To Day', 'Questionable'][s_suppkey % 4 + 1] as "Status",
  ['knee', 'ankle', 'rest', null][s_suppkey % 4 + 1] as "Description" from supplier)"""


@query("s9_injury_table", f"with {_INJURY_SQL} select * from injuries")
def s9_injuries(spark, sf):
    return injury_table(injury_pages(spark, sf), "html", ["s_suppkey"])


_AVAILABLE_SQL = f"""with {_LINEUP_SQL}, {_INJURY_SQL} select * from lineup l where not exists
  (select 1 from injuries i where i."Player" = l."playerName" and contains(i."Status", 'Out'))"""


def _available(spark, sf):
    injuries = injury_table(injury_pages(spark, sf), "html")
    return lineups.available_lineup(lineup_players(lineup_payloads(spark, sf), "payload"), injuries)


@query("j8_not_injured", _AVAILABLE_SQL)
def j8(spark, sf):
    return _available(spark, sf)


_STRENGTH_SQL = f"""select "TEAM_ID", round(sum("LAST_3_PPG"), 4) as "LAST_3_PPG",
  round(coalesce(sum("LAST_3_PPG_STDDEV"), 0), 4) as "LAST_3_PPG_STDDEV", round(sum("SEASON_PPG"), 4) as "SEASON_PPG",
  round(coalesce(sum("SEASON_PPG_STDDEV"), 0), 4) as "SEASON_PPG_STDDEV", round(avg("HEIGHT_INCHES"), 5) as "HEIGHT_INCHES",
  round(stddev_samp("HEIGHT_INCHES"), 5) as "STDDEV_HEIGHT_INCHES" from (%s) where "TEAM_ID" is not null group by 1"""
Q4_SQL = _STRENGTH_SQL % _snapshot_sql(f'select "personId" from ({_AVAILABLE_SQL})')


def _tidy(strength):
    digits = {"HEIGHT_INCHES": 5, "STDDEV_HEIGHT_INCHES": 5}
    return strength.withColumns(
        {c: F.round(c, digits.get(c, 4)) for c in strength.columns if c != "TEAM_ID"}
    )


def _strength(spark, sf):
    ids = _available(spark, sf)
    snapshot = snapshots.active_player_snapshot(player_logs(spark, sf), players(spark, sf), ids, 3, TIES)
    return lineups.lineup_strength(snapshot)


@query("q4_lineup_strength", Q4_SQL)
def q4(spark, sf):
    return _tidy(_strength(spark, sf))


@query("a9_lineup_aggregates", _STRENGTH_SQL % Q2_SQL)
def a9(spark, sf):
    return _tidy(lineups.lineup_strength(q2(spark, sf)))


def standings(spark, sf):
    w = F.col("WL") == "W"
    return (
        team_logs(spark, sf).groupBy(F.col("TEAM_ID").alias("TeamID"))
        .agg(F.count(F.when(w, 1)).alias("WINS"), F.count(F.when(~w, 1)).alias("LOSSES"))
        .withColumn("WinPCT", F.round(F.col("WINS") / (F.col("WINS") + F.col("LOSSES")), 3))
    )


_RECORDS_SQL = f"""with {S.TEAM_LOG} select "TEAM_ID", count(*) as "TEAM_GAMES_PLAYED",
  round(count(case when "WL" = 'W' then 1 end) / count(*), 3) as "TEAM_WIN_PCT" from team_log group by 1"""
AS_OF = dt.date(2001, 6, 15)
_MERGED_SQL = f"""select f.*, s.* exclude ("TEAM_ID"),
  case when "LAST_GAME_DATE_HOME" = date '2001-06-14' or "LAST_GAME_DATE_AWAY" = date '2001-06-14' then 1 else 0 end
    as "TEAM_2ND_OF_B2B", r.* exclude ("TEAM_ID")
from ({Q3_SQL}) f join ({Q4_SQL}) s using ("TEAM_ID") join ({_RECORDS_SQL}) r using ("TEAM_ID")"""


def _merged(spark, sf):
    return P.merge_inputs(q3(spark, sf), _tidy(_strength(spark, sf)), P.team_records(standings(spark, sf)), AS_OF)


@query("j10_merged_inputs", _MERGED_SQL)
def j10(spark, sf):
    return _merged(spark, sf)


_INPUT_NAMES = {
    "ACTIVE_PLAYERS_LAST_3_PPG": "LAST_3_PPG", "ACTIVE_PLAYERS_LAST_3_PPG_STDDEV": "LAST_3_PPG_STDDEV",
    "ACTIVE_PLAYERS_SEASON_PPG": "SEASON_PPG", "ACTIVE_PLAYERS_SEASON_POINTS_STDDEV": "SEASON_PPG_STDDEV",
    "TEAM_OPP_PPG": "SEASON_OPP_PPG", "TEAM_OPP_LAST_3_PPG": "LAST_3_OPP_PPG",
    "TEAM_2ND_OF_B2B": "TEAM_2ND_OF_B2B", "TEAM_GAMES_PLAYED": "TEAM_GAMES_PLAYED", "TEAM_WIN_PCT": "TEAM_WIN_PCT",
    "AVG_HEIGHT_INCHES": "HEIGHT_INCHES", "STDDEV_HEIGHT_INCHES": "STDDEV_HEIGHT_INCHES",
}
_INPUTS_SQL = f"""with merged as ({_MERGED_SQL}), today as ({TODAY_SQL})
select "gameDate", "homeTeam", "awayTeam", "OVER_UNDER", "LINE",
  {", ".join(f'{a}."{src}" as "{role}_{name}"' for role, a in (("HOME", "h"), ("AWAY", "v")) for name, src in _INPUT_NAMES.items())},
  h."SEASON_PPG_HOME" as "HOME_TEAM_PPG_AT_HOME", h."LAST_3_PPG_HOME" as "HOME_TEAM_LAST_3_PPG_AT_HOME",
  v."SEASON_PPG_AWAY" as "AWAY_TEAM_PPG_AWAY", v."LAST_3_PPG_AWAY" as "AWAY_TEAM_LAST_3_PPG_AWAY"
from today t left join merged h on h."TEAM" = t."homeTeam" left join merged v on v."TEAM" = t."awayTeam\""""


@query("j7_one_table_two_roles", _INPUTS_SQL)
def j7(spark, sf):
    return P.prediction_inputs(_merged(spark, sf), q5(spark, sf))


@query("q6_predictions")
def q6(spark, sf):
    """Both regressions over all games, applied to every line of the feed."""
    training = betting.betting_features(
        player_logs(spark, sf), players(spark, sf), lines(spark, sf), 3, TIES, lines_game_id="game_id"
    )
    return P.predictions(training, P.prediction_inputs(_merged(spark, sf), q5(spark, sf)))


@query("m1_linear_regression")
def m1(spark, sf):
    """Coefficients of the total-points model. The fit and its summary both read the rows, so they are stored once."""
    rows = _ou_training(spark, sf).select(*P.predictors(), P.TARGETS["ou"])
    model = P.train_model(stage(rows, "training-rows"), "ou")
    rows = [("intercept", float(model.intercept)), *zip(P.predictors(), map(float, model.coefficients.toArray()))]
    return spark.createDataFrame(rows, "predictor string, coefficient double")


def _ou_training(spark, sf):
    features = betting.betting_features(
        player_logs(spark, sf), players(spark, sf), lines(spark, sf), 3, TIES, lines_game_id="game_id"
    )
    return P.training_filter(features)


@query("m1_least_squares_qr")
def m1_qr(spark, sf):
    """Coefficients of the total-points model by a tall-skinny QR over all training rows; dependent ones kept False."""
    fit = M.least_squares_qr(_ou_training(spark, sf), P.predictors(), P.TARGETS["ou"])
    return spark.createDataFrame(
        list(zip(fit.names, fit.coefficients, fit.kept)), "predictor string, coefficient double, kept boolean"
    )


# The least-squares residual is orthogonal to every column of the design: its cosine with each is 0.
_ORTHOGONAL_SQL = "select predictor, cast(0 as double) as cosine from (values " + ", ".join(
    f"('{c}')" for c in ["intercept", *P.predictors()]
) + ") t(predictor)"


@query("m1_residual_orthogonality", _ORTHOGONAL_SQL)
def m1_orthogonality(spark, sf):
    """Cosine of the QR fit's residual with each predictor over all training rows, rounded to 6 places.

    The fit and the residuals both read the rows, so they are stored once.
    """
    columns = P.predictors()
    used = _ou_training(spark, sf).select(
        *[F.col(c).cast("double").alias(c) for c in columns], F.col(P.TARGETS["ou"]).cast("double").alias("__y")
    ).dropna()
    used = stage(used, "training-rows")
    fit = M.least_squares_qr(used, columns, "__y")
    fitted = F.lit(fit.coefficients[0])
    for c, b in zip(columns, fit.coefficients[1:]):
        fitted = fitted + F.lit(b) * F.col(c)
    residual = F.col("__y") - fitted
    with_residual = used.withColumn("__r", residual).withColumn("intercept", F.lit(1.0))
    sums = with_residual.agg(
        F.sum(F.col("__r") * F.col("__r")).alias("__rr"),
        *[F.sum(F.col(c) * F.col("__r")).alias(f"xr_{i}") for i, c in enumerate(["intercept", *columns])],
        *[F.sum(F.col(c) * F.col(c)).alias(f"xx_{i}") for i, c in enumerate(["intercept", *columns])],
    )
    rows = [
        F.struct(F.lit(c).alias("predictor"), F.abs(F.round(F.coalesce(
            F.col(f"xr_{i}") / F.sqrt(F.col(f"xx_{i}") * F.col("__rr")), F.lit(0.0)), 6)).alias("cosine"))
        for i, c in enumerate(["intercept", *columns])
    ]
    return sums.select(F.explode(F.array(*rows)).alias("row")).select("row.*")


def _with_place(ordered):
    """Adds each row's place in the order that the sort gave, without one task for all rows.

    The sort's range partitions come in order; each row's place is the rows of earlier partitions (one count per
    partition) plus its number within its own. Partition and id are stored first, so a re-run task cannot move rows.
    """
    placed = stage(
        ordered.withColumn("__part", F.spark_partition_id()).withColumn("__id", F.monotonically_increasing_id()),
        "sorted",
    )
    starts = (
        placed.groupBy("__part")
        .agg(F.count(F.lit(1)).alias("__n"))
        # One row per partition of the sort.
        .withColumn("__start", F.coalesce(F.sum("__n").over(
            Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    )
    here = Window.partitionBy("__part").orderBy("__id")
    return (
        placed.join(starts.select("__part", "__start"), "__part")
        .withColumn("place", (F.col("__start") + F.row_number().over(here)).cast("int"))
        .drop("__part", "__id", "__start")
    )


@query(
    "o1_sorted_desc",
    """select o_orderkey, o_custkey, cast(o_orderdate as date) as day,
  cast(row_number() over (order by cast(o_orderdate as date) desc, o_custkey desc, o_orderkey desc) as int) as place from orders""",
)
def o1(spark, sf):
    """The place is taken from the sorted output, so a wrong order shows."""
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("day"))
    return _with_place(sorted_desc(rows, "day", "o_custkey", "o_orderkey"))


@query("o2_sorted_report", f"select * from ({_SUMMARY}) order by dog_hit_percentage desc nulls last")
def o2(spark, sf):
    reports = L.LineReports(lines(spark, sf), todays_feed(spark, sf))
    return reports.sorted("coverage", "dog_hit_percentage")


@query("o3_latest_per_key", f"{Q2_SQL} order by \"Player_ID\", player_name desc")
def o3(spark, sf):
    """The limit equals the number of keys and so never cuts: sorting is all that is left of it."""
    return q2(spark, sf).orderBy("Player_ID", F.desc("player_name"))


@query("o3_order_limit", f"{Q2_SQL} order by \"Player_ID\", player_name desc limit 50")
def o3_limit(spark, sf):
    """The first 50 rows of the snapshot's order: the limit cuts, and Spark keeps 50 rows per task before merging."""
    return q2(spark, sf).orderBy("Player_ID", F.desc("player_name")).limit(50)


@query(
    "o4_top_k",
    "select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 10",
)
def o4(spark, sf):
    return top_k(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query("a10_distinct_games", f"""with {S.PLAYER_LOG} select distinct ltrim("Game_ID", '0') as game_id, "GAME_DATE", season from player_log""")
def a10(spark, sf):
    logs = player_logs(spark, sf).select(
        F.col("Game_ID").alias("game_id"), "GAME_DATE", F.year("GAME_DATE").alias("season")
    )
    return I.new_keys(logs, None, "game_id")


@query("a11_global_max", "select max(cast(o_orderdate as date)) as last_date, max(o_totalprice) as top_price from orders")
def a11(spark, sf):
    return table(spark, sf, "orders").agg(
        F.max(F.col("o_orderdate").cast("date")).alias("last_date"), F.max("o_totalprice").alias("top_price")
    )

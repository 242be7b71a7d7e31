"""Window operators, role aggregates and the betting features built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopline.operators.windows import (
    Measure,
    find_hot,
    latest_rows,
    over_rows,
    spread_max,
    to_date,
    trailing,
)
from hoopline.operators import increments as R
from hoopline.plans import betting
from hoopline.session import discard, stage, stage_alone
from workload import sql as S
from workload.registry import query
from workload.views import TIES, lines, player_logs, players

LOG_KEYS = ["season", "player_name", "Player_ID"]
LOG_ORDER = ["GAME_DATE", *TIES]
_OVER = 'partition by season, player_name, "Player_ID" order by "GAME_DATE", "Game_ID", "LINE_NO", "PTS"'
_LOG_COLUMNS = 'season, "Player_ID", "Game_ID", "GAME_DATE", "LINE_NO", "PTS"'


def _log_windows(spark, sf, measures):
    logs = player_logs(spark, sf).withColumn("season", F.year("GAME_DATE"))
    rows = logs.select(*LOG_KEYS, *LOG_ORDER)
    return over_rows(rows, LOG_KEYS, LOG_ORDER, measures).drop("player_name")


def _log_sql(*measures):
    picked = ", ".join(f"round({agg}(\"PTS\") over ({_OVER} rows between {frame}), 4) as {name}" for name, agg, frame in measures)
    return f"with {S.PLAYER_LOG} select {_LOG_COLUMNS}, {picked} from player_log"


@query("w1_trailing_avg", _log_sql(("last_3_ppg", "avg", "3 preceding and 1 preceding")))
def w1(spark, sf):
    return _log_windows(spark, sf, [Measure("last_3_ppg", "avg", "PTS", trailing(3), 4)])


@query("w2_trailing_stddev", _log_sql(("last_3_stddev", "stddev_samp", "3 preceding and 1 preceding")))
def w2(spark, sf):
    return _log_windows(spark, sf, [Measure("last_3_stddev", "stddev", "PTS", trailing(3), 4)])


@query(
    "w3_season_to_date",
    _log_sql(
        ("season_ppg", "avg", "unbounded preceding and 1 preceding"),
        ("season_stddev", "stddev_samp", "unbounded preceding and 1 preceding"),
    ),
)
def w3(spark, sf):
    return _log_windows(
        spark,
        sf,
        [
            Measure("season_ppg", "avg", "PTS", to_date(), 4),
            Measure("season_stddev", "stddev", "PTS", to_date(), 4),
        ],
    )



# Loads of the player logs by date; the cut points follow the data, every row is loaded once.
LOADS = 10


@query(
    "w4_rolling_by_increment",
    _log_sql(
        ("last_3_ppg", "avg", "3 preceding and 1 preceding"),
        ("season_ppg", "avg", "unbounded preceding and 1 preceding"),
        ("season_stddev", "stddev_samp", "unbounded preceding and 1 preceding"),
    ),
)
def w4(spark, sf):
    """w1 and w3 over all logs, loaded in ``LOADS`` increments by date: each load reads only the state and its rows."""
    logs = player_logs(spark, sf).withColumn("season", F.year("GAME_DATE"))
    rows = stage(logs.select(*LOG_KEYS, *LOG_ORDER).withColumn("__day", F.unix_date("GAME_DATE")), "logs-by-day")
    cuts = sorted(set(rows.approxQuantile("__day", [i / LOADS for i in range(1, LOADS)], 0.001)))
    measures = [
        Measure("last_3_ppg", "avg", "PTS", trailing(3), 4),
        Measure("season_ppg", "avg", "PTS", to_date(), 4),
        Measure("season_stddev", "stddev", "PTS", to_date(), 4),
    ]
    state, loaded = None, []
    for lo, hi in zip([None, *cuts], [*cuts, None]):
        # rows without a date sort first, so they are in the first load
        after = F.col("__day") > lo if lo is not None else F.lit(True)
        until = F.col("__day") <= hi if hi is not None else F.lit(True)
        load = rows.filter((after & until) | (F.col("__day").isNull() if lo is None else F.lit(False)))
        measured, state = R.advance(state, load.drop("__day"), LOG_KEYS, LOG_ORDER, measures)
        loaded.append(stage(measured, "rolling-load"))
    return reduce(DataFrame.unionByName, loaded).drop("player_name")

_FORM_SQL = f"""with {S.PLAYER_LOG}, {S.PLAYERS},
heights as (select "PERSON_ID", try_cast(split_part("HEIGHT", '-', 1) as double) * 12
    + try_cast(split_part("HEIGHT", '-', 2) as double) as inches from players),
form as (
  select p.*, h.inches,
    case when "WL" = 'W' then 1 else 0 end as w, case when "WL" = 'L' then 1 else 0 end as l,
    round(avg("PTS") over trail, 4) as last_avg, round(stddev_samp("PTS") over trail, 4) as last_std,
    round(avg("PTS") over so_far, 4) as season_avg, round(stddev_samp("PTS") over so_far, 4) as season_std
  from player_log p left join heights h on h."PERSON_ID" = p."Player_ID"
  window trail as ({_OVER} rows between 3 preceding and 1 preceding),
    so_far as ({_OVER} rows between unbounded preceding and 1 preceding))"""


def _roles_sql():
    out = []
    for role in ("home", "away"):
        for name, value in (
            ("AVG_HEIGHT_INCHES", "round(avg(inches), 5)"),
            ("STDDEV_HEIGHT_INCHES", "round(stddev_samp(inches), 5)"),
            ("PTS", 'sum("PTS")'),
            ("ACTIVE_PLAYERS_LAST_3_PPG", "sum(last_avg)"),
            ("ACTIVE_PLAYERS_LAST_3_PPG_STDDEV", "sum(last_std)"),
            ("ACTIVE_PLAYERS_SEASON_PPG", "sum(season_avg)"),
            ("ACTIVE_PLAYERS_SEASON_POINTS_STDDEV", "sum(season_std)"),
        ):
            out.append(
                f'case when "TEAM" = {role}_team then {value} else 0 end as "{role.upper()}_{name}"'
            )
    return ",\n    ".join(out)


_TEAM_GAME_SQL = _FORM_SQL + f""",
team_game as (
  select season as "SEASON", "GAME_DATE", "Game_ID" as "GAME_ID", home_team as "HOME_TEAM",
    away_team as "AWAY_TEAM", "TEAM", w as "W", l as "L",
    {_roles_sql()}
  from form group by 1, 2, 3, 4, 5, 6, 7, 8)"""

_ROUNDED_ROLES = ["ACTIVE_PLAYERS_LAST_3_PPG", "ACTIVE_PLAYERS_LAST_3_PPG_STDDEV",
                  "ACTIVE_PLAYERS_SEASON_PPG", "ACTIVE_PLAYERS_SEASON_POINTS_STDDEV"]


def _rounded_list():
    """Sums of rounded values may differ in their last bits with the order of addition."""
    return [f"{r}_{c}" for r in ("HOME", "AWAY") for c in _ROUNDED_ROLES]


def _rounded_sql(source):
    fix = ", ".join(f'round("{c}", 4) as "{c}"' for c in _rounded_list())
    return f"select * replace ({fix}) from {source}"


def _rounded(df):
    return df.withColumns({c: F.round(c, 4) for c in _rounded_list()})


def _player_form(spark, sf):
    rows = betting.clean_player_logs(player_logs(spark, sf), players(spark, sf), keep=["LINE_NO"])
    return betting.with_player_form(rows, 3, ["GAME_ID", "LINE_NO", "PLAYER_PTS"])


def _team_games(spark, sf):
    return betting.team_game_rows(_player_form(spark, sf), 3)


@query("a1_role_aggregates", f"{_TEAM_GAME_SQL} {_rounded_sql('team_game')}")
def a1(spark, sf):
    return _rounded(_team_games(spark, sf))


_SCORES_SQL = f"""with {S.PLAYER_LOG},
scored as (
  select season, "GAME_DATE", "Game_ID", home_team, away_team, "TEAM",
    case when "WL" = 'W' then 1 else 0 end as w, case when "WL" = 'L' then 1 else 0 end as l,
    case when "TEAM" = home_team then sum("PTS") else 0 end as home_pts,
    case when "TEAM" = away_team then sum("PTS") else 0 end as away_pts
  from player_log group by 1, 2, 3, 4, 5, 6, 7, 8)"""


def _scored(spark, sf):
    """Team-game scores without the form columns."""
    logs = player_logs(spark, sf).withColumn("season", F.year("GAME_DATE"))
    home = F.when(F.col("`HOME/AWAY`") == "HOME", F.col("TEAM")).otherwise(F.col("OPPONENT"))
    away = F.when(F.col("`HOME/AWAY`") == "AWAY", F.col("TEAM")).otherwise(F.col("OPPONENT"))
    keyed = logs.withColumns(
        {
            "home_team": home,
            "away_team": away,
            "w": F.when(F.col("WL") == "W", 1).otherwise(0),
            "l": F.when(F.col("WL") == "L", 1).otherwise(0),
        }
    )
    grouped = keyed.groupBy(
        "season", "GAME_DATE", "Game_ID", "home_team", "away_team", "TEAM", "w", "l"
    ).agg(F.sum("PTS").alias("pts"))
    return grouped.withColumns(
        {
            "home_pts": F.when(F.col("TEAM") == F.col("home_team"), F.col("pts")).otherwise(0),
            "away_pts": F.when(F.col("TEAM") == F.col("away_team"), F.col("pts")).otherwise(0),
        }
    ).drop("pts")


@query(
    "w4_cumulative_record",
    _SCORES_SQL + """
select season, "TEAM", "GAME_DATE", "Game_ID", cast(sum(w) over so_far as bigint) as cum_wins,
  cast(sum(l) over so_far as bigint) as cum_losses
from scored window so_far as (partition by season, "TEAM" order by "GAME_DATE", "Game_ID"
  rows between unbounded preceding and 1 preceding)""",
)
def w4(spark, sf):
    rows = _scored(spark, sf).select("season", "TEAM", "GAME_DATE", "Game_ID", "w", "l")
    return over_rows(
        rows,
        ["season", "TEAM"],
        ["GAME_DATE", "Game_ID"],
        [Measure("cum_wins", "sum", "w", to_date()), Measure("cum_losses", "sum", "l", to_date())],
    ).drop("w", "l")


@query(
    "w5_scores_on_both_rows",
    _SCORES_SQL + """
select "Game_ID", "TEAM",
  last_value(home_pts) over (partition by "Game_ID" order by home_pts asc nulls last
    rows between unbounded preceding and unbounded following) as home_pts,
  last_value(away_pts) over (partition by "Game_ID" order by away_pts asc nulls last
    rows between unbounded preceding and unbounded following) as away_pts
from scored""",
)
def w5(spark, sf):
    rows = _scored(spark, sf).select("Game_ID", "TEAM", "home_pts", "away_pts")
    return spread_max(rows, ["Game_ID"], ["home_pts", "away_pts"])


@query(
    "w6_second_night",
    _SCORES_SQL + """
select "TEAM", "Game_ID", "GAME_DATE",
  case when "GAME_DATE" - lag("GAME_DATE") over (partition by "TEAM" order by "GAME_DATE", "Game_ID") = 1
    then 1 else 0 end as second_night
from scored""",
)
def w6(spark, sf):
    rows = _scored(spark, sf).select("TEAM", "Game_ID", "GAME_DATE")
    gaps = over_rows(
        rows, ["TEAM"], ["GAME_DATE", "Game_ID"], [Measure("previous", "lag", "GAME_DATE")]
    )
    night = F.when(F.datediff("GAME_DATE", "previous") == 1, 1).otherwise(0)
    return gaps.withColumn("second_night", night).drop("previous")


_HISTORY_SQL = _TEAM_GAME_SQL + """,
both_scores as (
  select * replace (max("HOME_PTS") over (partition by "GAME_ID") as "HOME_PTS",
                    max("AWAY_PTS") over (partition by "GAME_ID") as "AWAY_PTS")
  from team_game),
history as (
  select *,
    cast(sum("W") over so_far as bigint) as cum_wins, cast(sum("L") over so_far as bigint) as cum_losses,
    case when "GAME_DATE" - lag("GAME_DATE") over (partition by "TEAM" order by "GAME_DATE", "GAME_ID") = 1
      then 1 else 0 end as second_night,
    case when "TEAM" = "HOME_TEAM" then round(avg("AWAY_PTS") over so_far, 4) else 0 end as home_opp,
    case when "TEAM" = "HOME_TEAM" then round(avg("AWAY_PTS") over last_n, 4) else 0 end as home_opp_last,
    case when "TEAM" = "AWAY_TEAM" then round(avg("HOME_PTS") over so_far, 4) else 0 end as away_opp,
    case when "TEAM" = "AWAY_TEAM" then round(avg("HOME_PTS") over last_n, 4) else 0 end as away_opp_last
  from both_scores
  window so_far as (partition by "SEASON", "TEAM" order by "GAME_DATE", "GAME_ID"
      rows between unbounded preceding and 1 preceding),
    last_n as (partition by "SEASON", "TEAM" order by "GAME_DATE", "GAME_ID"
      rows between 3 preceding and 1 preceding))"""


@query(
    "w7_opponent_points",
    _HISTORY_SQL + """
select "SEASON", "TEAM", "GAME_ID", home_opp as "HOME_TEAM_OPP_PPG", home_opp_last as "HOME_TEAM_OPP_LAST_3_PPG",
  away_opp as "AWAY_TEAM_OPP_PPG", away_opp_last as "AWAY_TEAM_OPP_LAST_3_PPG"
from history""",
)
def w7(spark, sf):
    history = betting.with_team_history(_team_games(spark, sf), 3)
    names = [f"{r}_TEAM_OPP_{x}PPG" for r in ("HOME", "AWAY") for x in ("", "LAST_3_")]
    return history.select("SEASON", "TEAM", "GAME_ID", *names)


def _games_sql():
    sums = ", ".join(f'sum("{c}") as "{c}"' for c in [
        *_rounded_list(),
        *[f"{r}_{x}_HEIGHT_INCHES" for r in ("HOME", "AWAY") for x in ("AVG", "STDDEV")],
    ])
    records = ", ".join(
        f'max(case when "TEAM" = "{r}_TEAM" then cum_{x} else 0 end) as "{r}_TEAM_CUM_{x.upper()}"'
        for r in ("HOME", "AWAY") for x in ("wins", "losses")
    )
    return _HISTORY_SQL + f""",
per_game as (
  select "SEASON", "GAME_DATE", "GAME_ID", "HOME_TEAM", "AWAY_TEAM", "HOME_PTS", "AWAY_PTS", {sums},
    sum(home_opp) as "HOME_TEAM_OPP_PPG", sum(home_opp_last) as "HOME_TEAM_OPP_LAST_3_PPG",
    sum(away_opp) as "AWAY_TEAM_OPP_PPG", sum(away_opp_last) as "AWAY_TEAM_OPP_LAST_3_PPG",
    cast(sum(case when "TEAM" = "HOME_TEAM" then second_night else 0 end) as bigint) as "HOME_TEAM_2ND_OF_B2B",
    cast(sum(case when "TEAM" = "AWAY_TEAM" then second_night else 0 end) as bigint) as "AWAY_TEAM_2ND_OF_B2B",
    {records}
  from history group by 1, 2, 3, 4, 5, 6, 7),
formed as (
  select *,
    round(avg("HOME_PTS") over (h rows between unbounded preceding and 1 preceding), 4) as "HOME_TEAM_PPG_AT_HOME",
    round(avg("AWAY_PTS") over (a rows between unbounded preceding and 1 preceding), 4) as "AWAY_TEAM_PPG_AWAY",
    round(avg("HOME_PTS") over (h rows between 3 preceding and 1 preceding), 4) as "HOME_TEAM_LAST_3_PPG_AT_HOME",
    round(avg("AWAY_PTS") over (a rows between 3 preceding and 1 preceding), 4) as "AWAY_TEAM_LAST_3_PPG_AWAY"
  from per_game
  window h as (partition by "SEASON", "HOME_TEAM" order by "GAME_DATE", "GAME_ID"),
    a as (partition by "SEASON", "AWAY_TEAM" order by "GAME_DATE", "GAME_ID"))"""


_GAMES_SQL = _games_sql()


def _games(spark, sf):
    """Players' form is stored by itself until the team rows are: its shuffles are gone before theirs begin."""
    form = stage_alone(lambda: _player_form(spark, sf), "player-form")
    history = betting.with_team_history(betting.team_game_rows(form, 3), 3)
    discard(form)
    return betting.game_rows(history, 3)


@query("a2_one_row_per_game", f"{_GAMES_SQL} {_rounded_sql('per_game')}")
def a2(spark, sf):
    form = ("PPG_AT_HOME", "LAST_3_PPG_AT_HOME", "PPG_AWAY", "LAST_3_PPG_AWAY")
    return _rounded(_games(spark, sf)).drop(*[f"{r}_TEAM_{x}" for r in ("HOME", "AWAY") for x in form])


@query(
    "w8_window_over_groups",
    _GAMES_SQL + """
select "SEASON", "GAME_ID", "HOME_TEAM", "AWAY_TEAM", "HOME_TEAM_PPG_AT_HOME", "AWAY_TEAM_PPG_AWAY",
  "HOME_TEAM_LAST_3_PPG_AT_HOME", "AWAY_TEAM_LAST_3_PPG_AWAY" from formed""",
)
def w8(spark, sf):
    return _games(spark, sf).select(
        "SEASON", "GAME_ID", "HOME_TEAM", "AWAY_TEAM", "HOME_TEAM_PPG_AT_HOME", "AWAY_TEAM_PPG_AWAY",
        "HOME_TEAM_LAST_3_PPG_AT_HOME", "AWAY_TEAM_LAST_3_PPG_AWAY",
    )


_LINE_CTES = S.LINES.replace(S.PLAYED + ",", "", 1)


def _q1_sql():
    keep = ", ".join(f'g."{c}"' for c in [
        *[f"{r}_TEAM_OPP_{x}PPG" for r in ("HOME", "AWAY") for x in ("", "LAST_3_")],
        "HOME_TEAM_PPG_AT_HOME", "AWAY_TEAM_PPG_AWAY", "HOME_TEAM_LAST_3_PPG_AT_HOME",
        "AWAY_TEAM_LAST_3_PPG_AWAY", "HOME_TEAM_2ND_OF_B2B", "AWAY_TEAM_2ND_OF_B2B",
        *[f"{r}_{x}_HEIGHT_INCHES" for r in ("HOME", "AWAY") for x in ("AVG", "STDDEV")],
    ])
    active = ", ".join(f'round(g."{c}", 4) as "{c}"' for c in _rounded_list())
    played = {r: f'(g."{r}_TEAM_CUM_WINS" + g."{r}_TEAM_CUM_LOSSES")' for r in ("HOME", "AWAY")}
    records = ", ".join(
        f'{played[r]} as "{r}_TEAM_GAMES_PLAYED", case when {played[r]} <> 0 then '
        f'round(cast(g."{r}_TEAM_CUM_WINS" as double) / {played[r]}, 5) end as "{r}_TEAM_WIN_PCT"'
        for r in ("HOME", "AWAY")
    )
    return f"""{_GAMES_SQL}, {_LINE_CTES}
select g."SEASON", g."GAME_DATE", g."HOME_TEAM", g."AWAY_TEAM", s.favorite as "FAVORITE",
  s.home_team_score as "HOME_SCORE", s.visit_team_score as "AWAY_SCORE", s.favorite_covered as "FAV_HIT",
  s.home_team_score - s.visit_team_score as "DIFF", s.total as "GAME_TOTAL_PTS",
  cast(s.over_hit as double) as "OVER_HIT", {active}, {keep}, {records}
from formed g join lines s on cast(s.game_date as date) = g."GAME_DATE" and s.home_team_abbrev = g."HOME_TEAM"
  and s.visit_team_abbrev = g."AWAY_TEAM" and s.game_id = g."GAME_ID\""""


@query("q1_betting_features", _q1_sql())
def q1(spark, sf):
    features = betting.betting_features(
        player_logs(spark, sf), players(spark, sf), lines(spark, sf), 3, TIES, lines_game_id="game_id"
    )
    return _rounded(features)


@query(
    "w9_trailing_with_current",
    _log_sql(
        ("last_3_ppg", "avg", "2 preceding and current row"),
        ("last_3_stddev", "stddev_samp", "2 preceding and current row"),
        ("season_ppg", "avg", "unbounded preceding and current row"),
        ("season_stddev", "stddev_samp", "unbounded preceding and current row"),
    ),
)
def w9(spark, sf):
    return _log_windows(
        spark,
        sf,
        [
            Measure("last_3_ppg", "avg", "PTS", trailing(3, True), 4),
            Measure("last_3_stddev", "stddev", "PTS", trailing(3, True), 4),
            Measure("season_ppg", "avg", "PTS", to_date(True), 4),
            Measure("season_stddev", "stddev", "PTS", to_date(True), 4),
        ],
    )


@query(
    "w10_latest_row",
    f"""with {S.PLAYER_LOG}, ranked as (
  select *, row_number() over (partition by "Player_ID"
    order by "GAME_DATE" desc, "Game_ID" desc, "LINE_NO" desc, "PTS" desc) as rn from player_log)
select "Player_ID", player_name, "GAME_DATE", "Game_ID", "LINE_NO", "PTS" from ranked where rn = 1""",
)
def w10(spark, sf):
    rows = player_logs(spark, sf).select("Player_ID", "player_name", *LOG_ORDER)
    return latest_rows(rows, ["Player_ID"], LOG_ORDER)


@query(
    "w1_split_hot_keys",
    f"""with {S.PLAYER_LOG}
select "HOME/AWAY", "Player_ID", "Game_ID", "GAME_DATE", "LINE_NO", "PTS",
  round(avg("PTS") over (trail rows between 3 preceding and 1 preceding), 4) as last_3_ppg,
  round(avg("PTS") over (trail rows between unbounded preceding and 1 preceding), 9) as ppg_to_date,
  round(stddev_samp("PTS") over (trail rows between unbounded preceding and 1 preceding), 6) as stddev_to_date
from player_log window trail as
  (partition by "HOME/AWAY" order by "GAME_DATE", "Game_ID", "LINE_NO", "PTS", "Player_ID")""",
)
def w1_split(spark, sf):
    """Two keys hold all rows, so the distributed way is taken whatever the scale."""
    rows = player_logs(spark, sf).select("HOME/AWAY", "Player_ID", *LOG_ORDER)
    order = [*LOG_ORDER, "Player_ID"]
    limit = 500
    (hot,) = find_hot(rows, ["HOME/AWAY"], rows_per_task=limit)
    return over_rows(
        rows,
        ["HOME/AWAY"],
        order,
        [
            Measure("last_3_ppg", "avg", "PTS", trailing(3), 4),
            Measure("ppg_to_date", "avg", "PTS", to_date(), 9),
            Measure("stddev_to_date", "stddev", "PTS", to_date(), 6),
        ],
        hot=hot,
        rows_per_task=limit,
    )

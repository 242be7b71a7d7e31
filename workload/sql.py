"""The same views as SQL for the comparison engine, written independently of the Spark ones."""

PLAYED = """
played as (
  select l.*, cast(o.o_orderdate as date) as game_date, l.l_linenumber % 2 = 1 as at_home,
    cast(c.c_nationkey as bigint) as home_id,
    cast((c.c_nationkey + 1 + l.l_orderkey % 24) % 25 as bigint) as away_id
  from lineitem l join orders o on l.l_orderkey = o.o_orderkey
  join customer c on o.o_custkey = c.c_custkey)"""

PLAYER_LOG = PLAYED + """,
player_log as (
  select '2' || cast(year(game_date) as varchar) as "SEASON_ID", cast(year(game_date) as int) as season,
    l_suppkey as "Player_ID", 'Player ' || cast(l_suppkey as varchar) as player_name,
    lpad(cast(l_orderkey as varchar), 10, '0') as "Game_ID", l_orderkey as game_key,
    game_date as "GAME_DATE",
    case when l_orderkey % 97 = 0 then null
         when (l_orderkey % 2 = 0) = at_home then 'W' else 'L' end as "WL",
    l_quantity as "PTS", l_linenumber as "LINE_NO",
    'T' || lpad(cast(case when at_home then home_id else away_id end as varchar), 2, '0') as "TEAM",
    'T' || lpad(cast(case when at_home then away_id else home_id end as varchar), 2, '0') as "OPPONENT",
    case when at_home then 'HOME' else 'AWAY' end as "HOME/AWAY",
    'T' || lpad(cast(home_id as varchar), 2, '0') as home_team,
    'T' || lpad(cast(away_id as varchar), 2, '0') as away_team
  from played)"""

PLAYERS = """
players as (
  select s_suppkey as "PERSON_ID", s_name as "DISPLAY_FIRST_LAST",
    case when s_suppkey % 50 = 7 then ''
         else cast(5 + s_suppkey % 3 as varchar) || '-' || cast(s_suppkey % 12 as varchar) end as "HEIGHT",
    cast(s_nationkey as bigint) as "TEAM_ID",
    cast(1995 + s_suppkey % 4 as int) as "FROM_YEAR",
    cast(1995 + s_suppkey % 4 + s_suppkey % 3 as int) as "TO_YEAR",
    case when s_suppkey % 5 = 0 then 'Undrafted' else cast(1985 + s_suppkey % 9 as varchar) end as "DRAFT_YEAR",
    case when s_suppkey % 5 <> 0 then cast(1 + s_suppkey % 2 as varchar) end as "DRAFT_ROUND",
    case when s_suppkey % 5 <> 0 then cast(1 + s_suppkey % 60 as varchar) end as "DRAFT_NUMBER"
  from supplier)"""

_STATS = {
    "n": "1",
    "pts": "l_quantity",
    "fgm": "l_linenumber",
    "fga": "l_linenumber + 2",
    "fg3m": "case when l_returnflag = 'R' then 1 else 0 end",
    "fg3a": "case when l_returnflag = 'A' then 1 else 2 end",
    "ftm": "case when l_linestatus = 'F' then 1 else 0 end",
    "fta": "case when l_partkey % 3 = 0 then 2 else 1 end",
    "oreb": "l_partkey % 5",
    "dreb": "l_partkey % 7",
    "ast": "l_suppkey % 6",
    "stl": "l_suppkey % 4",
    "blk": "l_suppkey % 3",
    "tov": "l_partkey % 4",
    "pf": "l_partkey % 6",
    "off_turnovers": "case when l_suppkey % 2 = 0 then l_quantity else 0 end",
    "second_chance": "case when l_partkey % 5 = 0 then l_quantity else 0 end",
    "fast_break": "case when l_partkey % 3 = 0 then l_quantity else 0 end",
    "paint": "case when l_partkey % 2 = 0 then l_quantity else 0 end",
    "cents": "cast(round(l_discount * 100) as int)",
}

GAMES = PLAYED + """,
games as (
  select l_orderkey as game_key, game_date, cast(year(game_date) as int) as season, home_id, away_id,
  """ + ",\n  ".join(
    f"cast(sum(case when {cond} then {expr} else 0 end) as double) as {side}_{name}"
    for side, cond in (("home", "at_home"), ("away", "not at_home"))
    for name, expr in _STATS.items()
) + """
  from played group by 1, 2, 3, 4, 5)"""

LINES = GAMES + """,
priced as (
  select *, game_key % 3 <> 0 as home_favored, cast(game_key % 15 as double) + 0.5 as spread,
    'T' || lpad(cast(home_id as varchar), 2, '0') as home_team_abbrev,
    'T' || lpad(cast(away_id as varchar), 2, '0') as visit_team_abbrev,
    case when game_key % 3 <> 0 then home_pts - away_pts else away_pts - home_pts end as margin
  from games),
lines as (
  select lpad(cast(game_key as varchar), 10, '0') as game_id, cast(game_date as varchar) as game_date,
    home_team_abbrev, visit_team_abbrev,
    case when home_favored then home_team_abbrev else visit_team_abbrev end as favorite,
    case when home_favored then visit_team_abbrev else home_team_abbrev end as underdog,
    case when home_favored then -spread else spread end as line, spread,
    100.0::double as game_over_under, home_pts + away_pts as total,
    home_pts as home_team_score, away_pts as visit_team_score,
    case when margin > spread then 1 else 0 end as favorite_covered,
    case when margin > spread then 0 else 1 end as underdog_covered,
    case when home_pts + away_pts > 100 then 1 else 0 end as over_hit,
    case when home_pts + away_pts > 100 then 0 else 1 end as under_hit
  from priced)"""


def _team_side(me: str, other: str, wins: str) -> str:
    return f"""
  select lpad(cast(game_key as varchar), 10, '0') as "GAME_ID", ltrim(cast(game_key as varchar), '0') as bare_id,
    game_date as "GAME_DATE", season as "SEASON_YEAR", {me}_id as "TEAM_ID",
    'T' || lpad(cast({me}_id as varchar), 2, '0') as "TEAM",
    'T' || lpad(cast({other}_id as varchar), 2, '0') as "OPPONENT", '{me.upper()}' as "HOME/AWAY",
    case when {wins} then 'W' else 'L' end as "WL",
    cast(240 + 5 * (game_key % 3) as double) as "MIN",
    {me}_fgm as "FGM", {me}_fga as "FGA", {me}_fgm / {me}_fga as "FG_PCT",
    {me}_fg3m as "FG3M", {me}_fg3a as "FG3A", {me}_fg3m / nullif({me}_fg3a, 0) as "FG3_PCT",
    {me}_ftm as "FTM", {me}_fta as "FTA", {me}_ftm / nullif({me}_fta, 0) as "FT_PCT",
    {me}_oreb as "OREB", {me}_dreb as "DREB", {me}_oreb + {me}_dreb as "REB",
    {me}_ast as "AST", {me}_stl as "STL", {me}_blk as "BLK", {me}_tov as "TOV", {me}_pf as "PF",
    {me}_pts as "PTS", {me}_pts - {other}_pts as "PLUS_MINUS"
  from games where {me}_n > 0"""


TEAM_LOG = GAMES + ",\nteam_log as (" + _team_side("home", "away", "game_key % 2 = 0") + """
  union all""" + _team_side("away", "home", "game_key % 2 <> 0") + ")"


def _misc_side(me: str, other: str) -> str:
    stats = ", ".join(
        f"{me}_{s} as {name}, {other}_{s} as opp_{name}"
        for s, name in (
            ("off_turnovers", "pts_off_turnovers"),
            ("second_chance", "second_chance_pts"),
            ("fast_break", "fast_break_pts"),
            ("paint", "paint_pts"),
        )
    )
    return f"select ltrim(cast(game_key as varchar), '0') as game_id, game_date as date, season, {me}_id as team_id, {stats} from games"


def _advanced_side(me: str) -> str:
    return (
        f"select ltrim(cast(game_key as varchar), '0') as game_id, game_date as date, season, {me}_id as team_id, "
        f"{me}_ast / nullif({me}_tov, 0) as assist_to_turnover, 90 + {me}_cents / 10 as pace from games"
    )


BOX = TEAM_LOG + f""",
misc as ({_misc_side("home", "away")} union {_misc_side("away", "home")}),
advanced as ({_advanced_side("home")} union {_advanced_side("away")})"""

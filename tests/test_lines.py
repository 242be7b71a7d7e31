from hoopline.operators.selection import non_members
from hoopline.plans import lines as L

SCHEMA = """game_date string, home_team_abbrev string, visit_team_abbrev string, favorite string, spread double,
home_team_score int, visit_team_score int, favorite_covered int, underdog_covered int, over_hit int"""
GAMES = [
    ("2024-01-01", "A", "B", "A", 3.5, 100, 90, 1, 0, 1),
    ("2024-01-02", "B", "A", "B", 1.5, 99, 98, 0, 1, 0),
    ("2024-01-03", "A", "B", "B", 2.5, 90, 100, 1, 0, 0),
    ("2024-01-04", "A", "C", "A", 7.5, 110, 90, 1, 0, 1),
    ("2024-01-05", "B", "A", "A", 4.5, 80, 90, 1, 0, 0),
]


def frame(spark):
    return L.with_underdog(spark.createDataFrame(GAMES, SCHEMA))


def test_underdog_is_the_other_side(spark):
    assert [r.underdog for r in frame(spark).orderBy("game_date").collect()] == ["B", "A", "A", "C", "B"]


def test_summary_needs_both_roles_and_is_sorted(spark):
    rows = L.coverage_summary(frame(spark)).collect()
    assert [r.team for r in rows] == ["A", "B"]  # C was never the favourite
    a = rows[0].asDict()
    assert (a["covered_as_favorite"], a["total_times_favorite"], a["fav_hit_percentage"]) == (3, 3, 100.0)
    assert (a["covered_as_dog"], a["total_times_underdog"], a["overall_hit_percentage"]) == (1, 2, 80.0)


def test_split_needs_both_places(spark):
    rows = {r.team: r for r in L.coverage_splits(frame(spark), "favorite").collect()}
    assert set(rows) == {"A", "B"}
    assert rows["A"].total_times_favorite_home == 2 and rows["A"].total_times_favorite_away == 1
    assert rows["B"].hit_percentage_as_favorite_home == 0.0
    underdogs = {r.team: r for r in L.coverage_splits(frame(spark), "underdog").collect()}
    assert set(underdogs) == {"A", "B"}  # C was an underdog away only
    assert underdogs["A"].covered_as_underdog_away == 1


def test_over_under(spark):
    rows = {r.team: r for r in L.over_under_splits(frame(spark)).collect()}
    assert set(rows) == {"A", "B"}  # C has no home game
    assert rows["A"].ppg_home == 100.0 and rows["A"].over_hit_home == 2
    assert rows["A"].over_hit_home_percentage == 2 / 3
    assert rows["A"].combined_ppg_away == rows["A"].ppg_away + rows["A"].opp_ppg_away


def test_coverage_by_side(spark):
    rows = L.coverage_by_side(frame(spark)).collect()
    home = next(r for r in rows if (r.team, r.home_away, r.fav_dog) == ("A", "home", "favorite"))
    assert (home.result, home.total_games, home.average_spread, home.std_spread) == ("covered", 2, 5.5, 2.83)
    assert home["1_std_away"] == 8.33
    single = next(r for r in rows if r.team == "C")
    assert single.std_spread is None and single["1_std_away"] is None
    listed = L.coverage_by_side(frame(spark), spark.createDataFrame([("C",)], "team string"))
    assert {r.team for r in listed.collect()} == {"C"}


def test_todays_lines_is_one_row_per_game(spark):
    raw = spark.createDataFrame(
        [
            ("1", "2024-01-01", "A", "B", "home", "-3.5", "220"),
            ("1", "2024-01-01", "B", "A", "away", "3.5", "220"),
            ("2", "2024-01-01", "C", "D", "home", None, "210"),
        ],
        "gameID string, gameDate string, abbr string, oppAbbr string, homeAway string, hardrock_spread string, hardrock_ou string",
    )
    rows = L.todays_lines(raw).collect()
    assert [(r.homeTeam, r.awayTeam, r.LINE, r.OVER_UNDER) for r in rows] == [("A", "B", -3.5, "220")]


def test_reports_check_the_metric_and_export(spark, tmp_path):
    today = spark.createDataFrame([("1", None), ("2", "x")], "gameID string, abbr string")
    reports = L.LineReports(frame(spark), today)
    worst_first = reports.sorted("coverage", "overall_hit_percentage", ascending=True)
    assert [r.team for r in worst_first.collect()] == ["B", "A"]
    try:
        reports.sorted("coverage", "team")
        raise AssertionError("an unlisted metric was accepted")
    except ValueError:
        pass
    reports.export(str(tmp_path))
    back = spark.read.option("header", True).csv(str(tmp_path / "coverage"))
    assert [r.team for r in back.collect()] == ["A", "B"]
    assert spark.read.option("header", True).csv(str(tmp_path / "todays_lines")).count() == 1


def test_a_null_on_the_right_excludes_nobody(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",), (None,)], "k string")
    assert {r.k for r in non_members(left, right, "k").collect()} == {"b", None}

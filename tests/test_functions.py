import datetime as dt

from pyspark.sql import functions as F

from hoopline.functions import numeric as N
from hoopline.functions import text as T


def one(spark, column, *values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    return [r[0] for r in df.select(column).collect()]


def test_matchup_ignores_extra_blanks(spark):
    df = spark.createDataFrame([(" AAA  @   BBB ",), ("CCC vs. DDD",)], "MATCHUP string")
    rows = T.with_matchup(df).select("TEAM", "OPPONENT", "HOME/AWAY").collect()
    assert [tuple(r) for r in rows] == [("AAA", "BBB", "AWAY"), ("CCC", "DDD", "HOME")]


def test_mixed_dates(spark):
    got = one(spark, T.mixed_date("x"), "APR 9, 2023", "2023-04-09", "2023-4-9", "soon", None)
    assert got == [dt.date(2023, 4, 9)] * 3 + [None, None]


def test_height_ids_and_lists(spark):
    assert one(spark, T.height_inches("x"), "6-7", "", None, "7-0") == [79.0, None, None, 84.0]
    assert one(spark, T.strip_zeros("x"), "0021900001", "219", "000") == ["21900001", "219", ""]
    assert one(spark, T.id_list("x"), "-1-22-3-") == [["1", "22", "3"]]
    assert one(spark, T.season_year("x"), "22019", "x") == [2019, None]


def test_draft_numbers(spark):
    assert one(spark, T.draft_number("x"), "Undrafted", "1996", None) == [0, 1996, 0]


def test_blanks(spark):
    df = spark.createDataFrame([("", 1), (" ", 2), ("a", 3)], "s string, n int")
    assert [r.s for r in T.blank_to_null(df).orderBy("n").collect()] == [None, " ", "a"]
    assert [r.s for r in T.blank_to_null(df, whitespace=True).orderBy("n").collect()] == [None, None, "a"]


def test_names(spark):
    assert T.snake_case("pointsOffTurnovers") == "points_off_turnovers"
    assert T.snake_case("home_pointsPaint") == "home_points_paint"
    df = spark.createDataFrame([(1, 2, 3)], "A int, A_RANK int, `B/C` int")
    assert T.drop_ranks(df).columns == ["a", "b/c"]
    assert T.rename(df, {"A": "X"}, "HOME_").columns == ["HOME_X", "HOME_A_RANK", "HOME_B/C"]


def test_ratio_and_total_guard_empty_input(spark):
    df = spark.createDataFrame([(1, 0), (3, 4)], "a int, b int")
    assert [r[0] for r in df.select(N.percentage("a", "b")).collect()] == [None, 75.0]
    none = spark.createDataFrame([(None,)], "a int")
    assert none.agg(N.total("a")).first()[0] == 0


def test_mean_fill_leaves_an_all_null_column(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None)], "a double, b double")
    assert [tuple(r) for r in N.fill_with_means(df, ["a", "b"]).collect()] == [(1.0, None), (2.0, None), (3.0, None)]


def test_second_night(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), dt.date(2023, 12, 1)), (None, dt.date(2024, 1, 1)), (None, None)], "h date, a date"
    )
    got = df.select(N.second_night(["h", "a"], F.lit(dt.date(2024, 1, 2)))).collect()
    assert [r[0] for r in got] == [1, 1, 0]


def test_mixed_date_meets_each_format_with_texts_of_its_shape_only(spark):
    texts = ["APR 9, 2023", "apr 09, 2023", " 2023-04-09 ", "2023-4-9T10:00:00", "2023-04-31", "9 APR 2023", "", "x", None, "Ä 1, 2023"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string").withColumn("d", T.mixed_date("s"))
    day = dt.date(2023, 4, 9)
    assert [r.d for r in df.orderBy("i").collect()] == [day, day, day, day, None, None, None, None, None, None]
    # a parse that cannot succeed raises inside Spark for each row, so both parses stand behind a condition
    assert str(T.mixed_date("s")).upper().count("CASE WHEN") >= 2

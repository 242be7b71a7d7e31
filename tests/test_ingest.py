import datetime as dt
import json

import pytest
from pyspark.sql import types as T

from hoopline.operators import ingest as I
from hoopline.plans import ingest as P
from hoopline.sources import html, payloads, tables


def test_new_keys_ignore_leading_zeros(spark):
    source = spark.createDataFrame([("0021",), ("0021",), ("22",)], "game_id string")
    target = spark.createDataFrame([("21",), (None,)], "game_id string")
    assert [r.game_id for r in I.new_keys(source, target, "game_id").collect()] == ["22"]
    assert {r.game_id for r in I.new_keys(source, None, "game_id").collect()} == {"21", "22"}


def test_marks(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2023, 1, 1),)], "d date")
    assert tuple(I.next_load_date(df, "d").first()) == (dt.date(2024, 2, 1), "02/01/2024")
    assert I.since_mark(df, "d", df.limit(0), "d").count() == 2
    assert I.since_mark(df, "d", df.filter("d < '2024-01-01'"), "d").count() == 1
    assert I.latest_season(df.selectExpr("year(d) y").limit(0), "y").first().season == 1979


def test_season_id_filter_compares_the_whole_id(spark):
    df = spark.createDataFrame([("21996",), ("32000",), ("12020",), ("21995",), ("41950",)], "s string")
    assert {r.s for r in df.filter(I.season_id_filter("s")).collect()} == {"21996", "32000", "41950"}


def test_write_modes_and_alignment(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    root = str(tmp_path)
    assert not tables.table_exists(spark, root, "g", "t")
    tables.write_table(df, root, "g", "t", "fail")
    assert tables.table_exists(spark, root, "g", "t")
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_table(df, root, "g", "t", "fail")
    with pytest.raises(ValueError):
        tables.write_table(df, root, "g", "t", "merge")
    target = T.StructType([T.StructField("s", T.StringType()), T.StructField("n", T.LongType())])
    assert tables.align_to(df, target).schema == target
    with pytest.raises(ValueError):
        tables.align_to(df.drop("n"), target)


def test_reload_keeps_other_seasons(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.reload_partition(spark.createDataFrame([(1, 2020), (2, 2021)], "v int, season int"), path, "season")
    tables.reload_partition(spark.createDataFrame([(9, 2021)], "v int, season int"), path, "season")
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(1, 2020), (9, 2021)}


def test_result_set_is_read_by_header(spark):
    docs = [
        {"resultSets": [{"headers": ["A", "B"], "rowSet": [[1, "x"], ["bad", "y"]]}]},
        {"resultSets": [{"headers": ["B", "A"], "rowSet": [["z", 3]]}]},
        {"resultSets": [{"headers": ["A"], "rowSet": []}]},
    ]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "payload string")
    schema = T.StructType([T.StructField("A", T.IntegerType()), T.StructField("B", T.StringType())])
    rows = {tuple(r) for r in payloads.flatten_result_set(df, "payload", schema).collect()}
    assert rows == {(1, "x"), (None, "y"), (3, "z")}


def test_player_logs_second_run_adds_nothing(spark, tmp_path):
    def doc(rows):
        headers = ["Player_ID", "GAME_DATE", "MATCHUP", "PTS"]
        return (json.dumps({"resultSets": [{"headers": headers, "rowSet": rows}]}),)

    first = [doc([[1, "APR 9, 2023", "AAA @ BBB", 10], [1, "APR 9, 2023", "AAA @ BBB", 10]])]
    second = first + [doc([[1, "2023-04-11", "AAA vs. CCC", 12], [7, "2023-04-11", "X vs. Y", 1]])]
    columns = T._parse_datatype_string("Player_ID long, GAME_DATE string, MATCHUP string, PTS int")
    target = T._parse_datatype_string("Player_ID long, GAME_DATE date, TEAM string, `HOME/AWAY` string, player_name string, PTS int")
    active = spark.createDataFrame([(1, "Ann")], "id long, full_name string")
    for batch in (first, second, second):
        path = P.ingest_player_logs(spark.createDataFrame(batch, "payload string"), columns, active, target, str(tmp_path))
    rows = {tuple(r) for r in spark.read.parquet(path).collect()}
    assert rows == {
        (1, dt.date(2023, 4, 9), "AAA", "AWAY", "Ann", 10),
        (1, dt.date(2023, 4, 11), "AAA", "HOME", "Ann", 12),
    }


def test_json_and_csv_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"a": 1, "b": "x"},\n {"a": 2, "b": "y"}]')
    schema = T._parse_datatype_string("a int, b string")
    assert {r.a for r in payloads.read_records(spark, str(tmp_path / "a.json"), schema, ["a"]).collect()} == {1, 2}
    assert payloads.read_payloads(spark, str(tmp_path / "a.json")).count() == 1
    (tmp_path / "b.csv").write_text("a,b\n1,x\n")
    assert tuple(tables.read_csv(spark, str(tmp_path / "b.csv"), schema).first()) == (1, "x")


def test_injury_table(spark):
    page = """<table><tr><th>Player</th><th>Team</th><th>Update</th><th>Description</th></tr>
    <tr><th><a href="#">Ann</a></th><td>AAA</td><td>Mon</td><td>Out - knee - left</td></tr>
    <tr><th>Bob</th><td>BBB</td><td>Tue</td><td>Day To Day</td></tr></table>"""
    rows = html.injury_table(spark.createDataFrame([(page,)], "html string"), "html").collect()
    assert [tuple(r) for r in rows] == [("Ann", "AAA", "Mon", "Out", "knee"), ("Bob", "BBB", "Tue", "Day To Day", None)]


def test_first_load_keeps_unlisted_players_and_restore_replaces(spark, tmp_path):
    doc = {
        "resultSets": [
            {
                "headers": ["Player_ID", "GAME_DATE", "MATCHUP", "VIDEO_AVAILABLE"],
                "rowSet": [[1, "APR 9, 2023", "AAA @ BBB", 1], [2, "APR 9, 2023", "BBB vs. AAA", 1]],
            }
        ]
    }
    columns = T._parse_datatype_string("Player_ID long, GAME_DATE string, MATCHUP string, VIDEO_AVAILABLE int")
    players = spark.createDataFrame([(1, "Ann")], "PERSON_ID long, DISPLAY_FIRST_LAST string")
    landed = spark.createDataFrame([(json.dumps(doc),)], "payload string")
    rows = P.shape_all_player_logs(landed, columns, players)
    assert "MATCHUP" not in rows.columns and "VIDEO_AVAILABLE" not in rows.columns
    assert {(r.Player_ID, r.player_name) for r in rows.collect()} == {(1, "Ann"), (2, None)}
    for backup in (rows, rows.limit(1)):
        path = P.restore_table(backup, str(tmp_path), "gamelogs", "player_gamelogs")
    assert spark.read.parquet(path).count() == 1


def test_partitioned_write(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id % 3 as season")
    path = tables.write_table(df, str(tmp_path), "g", "t", "replace", partition_by=["season"])
    assert spark.read.parquet(path).filter("season = 1").count() == 33

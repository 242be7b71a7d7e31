"""Documents that do not parse become rejects with a reason; counts add up."""

from pyspark.sql import types as T

from hoopline.sources.payloads import checked_boxscores, checked_result_set, player_rows

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
GOOD = '{"resultSets": [{"headers": ["name", "id"], "rowSet": [["a", "1"], ["b", "2"]]}]}'


def test_result_set_rejects_and_counts(spark):
    docs = spark.createDataFrame(
        [(1, GOOD), (2, GOOD[:20]), (3, '{"other": 1}'), (4, None), (5, '{"resultSets": []}'), (6, '{"resultSets": "x"}')],
        "k long, payload string",
    )
    landed = checked_result_set(docs, "payload", SCHEMA, keep=["k"])
    assert landed.counts == {"documents": 6, "rejected": 5, "parsed": 1}
    assert sorted((r.k, r.reason) for r in landed.rejects.collect()) == [
        (2, "malformed"), (3, "no result set"), (4, "null"), (5, "no result set"), (6, "malformed")]
    assert sorted((r.k, r.id, r.name) for r in landed.rows.collect()) == [(1, 1, "a"), (1, 2, "b")]


def test_boxscore_rejects(spark):
    doc = '{"gameId": "g1", "homeTeam": {"teamId": 1, "players": [{"personId": 7, "statistics": {"p": 3}}]}}'
    docs = spark.createDataFrame([(doc,), ('{"homeTeamId": 1}',), ("[",)], "payload string")
    landed = checked_boxscores(docs, "payload", ["p"])
    assert sorted(r.reason for r in landed.rejects.collect()) == ["malformed", "no game"]
    assert [(r.game_id, r.player_id, r.p) for r in player_rows(landed.rows, ["p"]).collect()] == [("g1", 7, 3.0)]

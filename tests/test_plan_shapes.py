"""What large tables rest on: how often rows are dealt anew, how often a result is made, how many tasks a sort gets."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from hoopline.operators import windows as W
from hoopline.plans import predictions as P
from hoopline.plans.boxscore import MISC_METRICS, feature_matrix, side_rows
from workload import betting, load_all, reports, storage
from workload.views import games, team_misc

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def staged(spark, label):
    return sorted(Path(spark.conf.get("spark.checkpoint.dir")).glob(f"{label}-*"))


def test_line_items_are_dealt_once_for_joins_and_sums(spark, shuffled_joins):
    # customer, orders, orders with customers, line items; the sums per game need no more
    assert exchanges(games(spark, SF)) == 4


def test_sides_are_dealt_once_for_distinct_and_join(spark, shuffled_joins):
    g = spark.createDataFrame([], games(spark, SF).schema)
    side = side_rows(team_misc(spark, SF, g), MISC_METRICS, 0)
    other = side.select("game_id", "team_id", F.col("paint_pts").alias("other"))
    assert exchanges(side.join(other, ["game_id", "team_id"])) <= 2


def test_matrix_rows_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        made.add(1)
        return x

    rows = [(i, "T", float(i), 1.0, 2.0, 1.0, i % 2, None if i == 3 else float(i)) for i in range(20)]
    names = "game_id int, team string, fgm double, fg3m double, fga double, fg3a double, `win?` int, x double"
    boxes = spark.createDataFrame(rows, names).withColumn("x", seen("x"))
    filled = {r.game_id: r.x for r in feature_matrix(boxes, ["x"]).collect()}
    assert filled[3] == pytest.approx(sum(i for i in range(20) if i != 3) / 19) and filled[4] == 4.0
    assert made.value == 20


@pytest.mark.parametrize("name", ["m1", "m1_orthogonality"])
def test_training_rows_are_made_once(spark, monkeypatch, name):
    load_all()
    made = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def target(i):
        made.add(1)
        return 3.0 * (i % 7) + i % 5

    target = target.asNondeterministic()  # called once a row wherever the plan names it
    columns = {c: ((F.col("id") * (k + 3)) % (11 + k)).cast("double") for k, c in enumerate(P.predictors())}
    games_played = {c: F.lit(50.0) + columns[c] for c in columns if c.endswith("GAMES_PLAYED")}
    rows = spark.range(300).select(
        *[{**columns, **games_played}[c].alias(c) for c in columns], target("id").alias(P.TARGETS["ou"])
    )
    monkeypatch.setattr(reports, "_ou_training", lambda spark, sf: rows)
    if name == "m1":
        monkeypatch.setattr(reports.betting, "betting_features", lambda *a, **k: rows)
        monkeypatch.setattr(reports, "player_logs", lambda *a: None)
        monkeypatch.setattr(reports, "players", lambda *a: None)
        monkeypatch.setattr(reports, "lines", lambda *a: None)
    found = getattr(reports, name)(spark, SF).collect()
    assert len(found) == 27 and made.value == 300
    if name == "m1_orthogonality":
        assert all(r.cosine == 0 for r in found)


def test_small_blocks_are_bounded_and_positions_exact(spark, monkeypatch):
    monkeypatch.setattr(W, "MAX_BLOCKS", 7, raising=False)
    before = set(staged(spark, "busy-blocks"))
    df = spark.range(300).select((F.col("id") % 2).alias("k"), ((F.col("id") * 37) % 300).alias("v"))
    measures = [W.Measure("so_far", "sum", "v", W.to_date()), W.Measure("last", "lag", "v")]
    rows = W.over_rows(df, ["k"], ["v"], measures, rows_per_task=1).orderBy("k", "v").collect()
    total, previous = {}, {}
    for r in rows:
        assert (r.so_far, r.last) == (total.get(r.k), previous.get(r.k))
        total[r.k], previous[r.k] = total.get(r.k, 0) + r.v, r.v
    (folder,) = set(staged(spark, "busy-blocks")) - before
    assert len(rows) == 300 and len(list(folder.glob("part-*"))) <= 7
    monkeypatch.undo()
    assert W.rows_per_block(36_000_000, 500) == 36_000 and W.rows_per_block(400_000, 500) == 500


def test_lines_landings_and_loads_make_their_rows_once(spark):
    before = {label: len(staged(spark, label)) for label in ("raw-lines", "lines-shaped")}
    storage.q11_lines(spark, SF).count()
    # one table of lines for both landings; the distinct rows of each landing once
    assert len(staged(spark, "raw-lines")) - before["raw-lines"] == 1
    assert len(staged(spark, "lines-shaped")) - before["lines-shaped"] == 2


def test_boxscore_loads_make_documents_once(spark):
    before = {label: set(staged(spark, label)) for label in ("landed-boxscores", "wanted-games")}
    storage.q11_boxscores(spark, SF).count()
    made = {label: set(staged(spark, label)) - seen for label, seen in before.items()}
    assert len(made["landed-boxscores"]) == 1
    # two loads of two tables; the second load wants no games
    assert sorted(spark.read.parquet(str(path)).count() > 0 for path in made["wanted-games"]) == [False, False, True, True]


def test_player_log_loads_make_the_logs_once(spark):
    before = set(staged(spark, "landed-logs"))
    storage.q11_player_logs(spark, SF).count()
    assert len(set(staged(spark, "landed-logs")) - before) == 1


def test_rows_are_stored_before_their_window_keys_are_counted(spark):
    before = {label: len(staged(spark, label)) for label in ("team-games", "game-rows")}
    betting.a2(spark, SF)
    # counting the keys of four windows used to make all rows again each time
    assert all(len(staged(spark, label)) - n == 1 for label, n in before.items())

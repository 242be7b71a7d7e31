"""What a step leaves on disk: its stored result, neither its shuffles nor the tables that only led to it."""

import time
from pathlib import Path

from pyspark.sql import functions as F
from test_betting import fixture

from hoopline.plans import betting
from hoopline.session import stage, stage_alone
from workload import betting as games


def stored(spark):
    return {p.name for p in Path(spark.conf.get("spark.checkpoint.dir")).iterdir()}


def shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}


def test_a_stored_step_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = stage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "counts")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert rows.count() == 100 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_tables_that_led_to_a_step_go_with_it(spark):
    before = stored(spark)
    kept = stage(spark.range(3), "kept")
    out = stage_alone(lambda: stage_alone(lambda: stage(kept, "inner"), "middle").join(kept, "id"), "outer")
    assert {x.split("-")[0] for x in stored(spark) - before} == {"kept", "outer"}
    assert out.count() == 3


def test_betting_features_keep_one_table_of_games(spark):
    before = stored(spark)
    out = betting.betting_features(*fixture(spark), rows_per_task=10)
    assert {x.rsplit("-", 1)[0] for x in stored(spark) - before} == {"games-with-form", "hot-keys"}
    assert out.count() > 0


def test_the_form_of_one_row_per_game_goes_with_its_use(spark, monkeypatch):
    kept, made, before = games.stage_alone, [], stored(spark)
    monkeypatch.setattr(games, "stage_alone", lambda make, label: made.append(label) or kept(make, label))
    out = games.a2(spark, "/root/testdata/sf0.001")
    left = {x.rsplit("-", 1)[0] for x in stored(spark) - before}
    assert made == ["player-form"] and "player-form" not in left and {"team-games", "game-rows"} <= left
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey").distinct().count()

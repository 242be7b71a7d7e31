"""The key index reads only files that may hold a wanted key and gives the same rows as the plain check."""

from pyspark.sql import functions as F

from hoopline.operators.ingest import new_keys
from hoopline.operators.key_index import new_keys_indexed, store_with_key_index


def test_same_rows_as_plain_check_reading_few_files(spark, tmp_path):
    stored = spark.range(0, 10000).select(F.lpad(F.col("id").cast("string"), 8, "0").alias("gameId"))
    path = str(tmp_path / "stored")
    store_with_key_index(stored, path, "gameId", 10)
    keys = [f"{k:06d}" for k in range(2000, 2100)] + [str(k) for k in range(20000, 20010)] + [None, "0002050"]
    source = spark.createDataFrame([(k, 1) for k in keys] * 2, "game_id string, other int")
    check = new_keys_indexed(source, path, "game_id", "gameId")
    plain = new_keys(source, spark.read.parquet(path), "game_id", "gameId")
    got = sorted(check.rows.collect(), key=str)
    assert got == sorted(plain.collect(), key=str)
    # new keys and the null key stay; each once
    assert sorted((r.game_id or "") for r in got) == sorted([""] + [str(k) for k in range(20000, 20010)])
    assert check.files_total == 10 and 1 <= len(check.files_read) <= 2


def test_empty_table_and_no_hits(spark, tmp_path):
    path = str(tmp_path / "empty")
    store_with_key_index(spark.createDataFrame([], "gameId string"), path, "gameId", 4)
    source = spark.createDataFrame([("7",), ("8",)], "game_id string")
    check = new_keys_indexed(source, path, "game_id", "gameId")
    assert check.files_read == [] and sorted(r.game_id for r in check.rows.collect()) == ["7", "8"]

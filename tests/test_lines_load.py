"""Lines loads by snapshot diff: statuses, rejects with counts, and only changed seasons rewritten."""

import json
import os

from pyspark.sql import types as T

from hoopline.operators.diff import snapshot_diff
from hoopline.plans.ingest import ingest_lines
from hoopline.sources.payloads import read_landed

COLUMNS = T.StructType(
    [
        T.StructField("game_id", T.StringType()),
        T.StructField("game_date", T.StringType()),
        T.StructField("home_team_abbrev", T.StringType()),
        T.StructField("visit_team_abbrev", T.StringType()),
        T.StructField("favorite", T.StringType()),
        T.StructField("spread", T.DoubleType()),
    ]
)


def game(i, year, spread=3.5, fav_home=True):
    return {"game_id": f"{i:04d}", "game_date": f"{year}-01-0{1 + i % 9}", "home_team_abbrev": "AAA",
            "visit_team_abbrev": "BBB", "favorite": "AAA" if fav_home else "BBB", "spread": spread}


def land(folder, name, records, broken=()):
    path = os.path.join(folder, name)
    os.makedirs(path)
    with open(os.path.join(path, "part-0.json"), "w") as f:
        for r in records:
            f.write(json.dumps(r) + "\n")
        for b in broken:
            f.write(b + "\n")
    return path


def files_of(folder):
    return sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))


def test_diff_statuses_with_repeated_and_null_keys(spark):
    schema = "k string, v int, p string"
    landed = spark.createDataFrame([("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y"), ("d", 4, "y"), ("d", 5, "y"), (None, 9, "z")], schema)
    stored = spark.createDataFrame([("a", 1, "x"), ("b", 7, "x"), ("d", 4, "y"), ("e", 5, "w"), (None, 9, "z")], schema)
    got = {r.k: (r.status, sorted(r.landed_parts), sorted(r.stored_parts)) for r in snapshot_diff(landed, stored, ["k"], ["k", "v"], "p").collect()}
    assert got == {
        "a": ("equal", ["x"], ["x"]), "b": ("changed", ["x"], ["x"]), "c": ("new", ["y"], []),
        "d": ("changed", ["y"], ["y"]), "e": ("vanished", [], ["w"]), None: ("equal", ["z"], ["z"]),
    }


def test_rejects_are_kept_and_counted(spark, tmp_path):
    path = land(str(tmp_path), "l", [game(1, 2001), game(2, 2001)], ['{"game_id": "0003", "spread": "abc"}', "{broken", "[1, 2"])
    landed = read_landed(spark, path, COLUMNS)
    assert landed.counts == {"landed": 5, "rejected": 3, "rows": 2}
    assert sorted(r.game_id for r in landed.rows.collect()) == ["0001", "0002"]
    assert {r.record for r in landed.rejects.collect()} == {'{"game_id": "0003", "spread": "abc"}', "{broken", "[1, 2"}


def test_second_load_rewrites_only_changed_seasons(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    first = [game(1, 2001), game(2, 2001), game(3, 2002), game(4, 2003), game(5, 2004)]
    one = ingest_lines(spark, land(str(tmp_path), "a", first, ["oops"]), COLUMNS, root)
    assert one.counts | {} == {"landed": 6, "rejected": 1, "rows": 5, "new": 5, "changed": 0, "equal": 0, "vanished": 0,
                               "seasons_written": 4, "seasons_removed": 0}
    kept_files = files_of(f"{one.path}/season=2001")
    # 2001 equal (with a repeated record), 2002 changed, 2003 gone, 2004 equal, 2005 new
    later = [game(1, 2001), game(2, 2001), game(2, 2001), game(3, 2002, spread=4.5), game(5, 2004), game(6, 2005)]
    two = ingest_lines(spark, land(str(tmp_path), "b", later), COLUMNS, root)
    assert {k: two.counts[k] for k in ("new", "changed", "equal", "vanished", "seasons_written", "seasons_removed")} == {
        "new": 1, "changed": 1, "equal": 3, "vanished": 1, "seasons_written": 2, "seasons_removed": 1}
    assert files_of(f"{two.path}/season=2001") == kept_files
    assert not os.path.exists(f"{two.path}/season=2003")
    stored = sorted((r.game_id, r.spread, r.underdog) for r in spark.read.parquet(two.path).collect())
    assert stored == [("0001", 3.5, "BBB"), ("0002", 3.5, "BBB"), ("0003", 4.5, "BBB"), ("0005", 3.5, "BBB"), ("0006", 3.5, "BBB")]
    rejects = spark.read.parquet(f"{root}/general/lines_rejects").collect()
    assert [r.record for r in rejects] == ["oops"]


def test_same_landing_twice_writes_nothing(spark, tmp_path):
    root = str(tmp_path / "w")
    records = [game(i, 2000 + i % 3) for i in range(12)]
    ingest_lines(spark, land(str(tmp_path), "a", records), COLUMNS, root)
    again = ingest_lines(spark, land(str(tmp_path), "b", records), COLUMNS, root)
    assert (again.counts["equal"], again.counts["seasons_written"], again.counts["new"]) == (12, 0, 0)

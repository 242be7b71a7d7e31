import importlib.util
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


def load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


entry = load("spark_entry", ROOT / "__spark_entry__.py")
compare = load("compare", ROOT / "tools" / "compare.py")
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")


def test_every_sql_has_its_query():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries)
    assert len(queries) > 100 and len(oracles) > 90


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert len(df.columns) == 37 and df.count() > 0


@pytest.mark.parametrize(
    "name",
    ["q1_betting_features", "q2_active_player_snapshot", "q3_team_snapshot", "q7_line_reports", "a8_coverage_by_side",
     "q4_lineup_strength", "q9_team_boxscore_features", "m9_anova_f", "s9_list_items", "w1_split_hot_keys"],
)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in compare.TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    status, note, _ = compare.compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF)
    assert status == "OK", note

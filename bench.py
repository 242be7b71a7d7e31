"""Times the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from hoopline.session import SETTINGS  # noqa: E402
from workload import load_all  # noqa: E402
from workload.registry import QUERIES  # noqa: E402

HEADLINE = [
    "w1_trailing_avg",
    "w9_trailing_with_current",
    "w10_latest_row",
    "a5_coverage_summary",
    "a8_coverage_by_side",
    "q7_line_reports",
    "q1_betting_features",
    "q2_active_player_snapshot",
    "q3_team_snapshot",
    "q9_team_boxscore_features",
    "m9_anova_f",
    "i2_new_keys",
    "q4_lineup_strength",
    "j7_one_table_two_roles",
    "q6_predictions",
    "q11_ingest_boxscores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (
        builder.config("spark.sql.shuffle.partitions", cpus)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    load_all()
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    seconds = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

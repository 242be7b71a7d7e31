"""Snapshot diff: what a new landing changes in a stored table, by keys and row hashes.

Only keys, a 256-bit hash of each row and its partition value cross the shuffle, never the stored rows
themselves. Rows are matched on (keys, hash) in one full outer join; a key whose rows all match is ``equal``,
one only landed is ``new``, one only stored is ``vanished``, any other ``changed``. A key may hold several rows
(a key with a repeated row on one side only counts as changed). Null keys match each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("new", "changed", "equal", "vanished")


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's values as JSON, nulls written out."""
    fields = F.struct(*[F.col(f"`{c}`") for c in columns])
    return F.sha2(F.to_json(fields, {"ignoreNullFields": "false"}), 256)


def snapshot_diff(
    landed: DataFrame, stored: DataFrame, keys: Sequence[str], compared: Sequence[str], part: str
) -> DataFrame:
    """Per key: the keys, ``status`` and the partition values it has in the landing and in the stored table."""
    a = landed.select(*[F.col(f"`{k}`").alias(f"a_{i}") for i, k in enumerate(keys)],
                      row_hash(compared).alias("a_h"), F.col(f"`{part}`").alias("a_p"))
    b = stored.select(*[F.col(f"`{k}`").alias(f"b_{i}") for i, k in enumerate(keys)],
                      row_hash(compared).alias("b_h"), F.col(f"`{part}`").alias("b_p"))
    same = [F.col(f"a_{i}").eqNullSafe(F.col(f"b_{i}")) for i in range(len(keys))] + [F.col("a_h") == F.col("b_h")]
    on = same[0]
    for c in same[1:]:
        on = on & c
    in_a, in_b = F.col("a_h").isNotNull(), F.col("b_h").isNotNull()
    pairs = a.join(b, on, "full_outer").select(
        *[F.when(in_a, F.col(f"a_{i}")).otherwise(F.col(f"b_{i}")).alias(k) for i, k in enumerate(keys)],
        in_a.alias("in_a"), in_b.alias("in_b"), "a_p", "b_p",
    )
    per_key = pairs.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.min(F.col("in_a") & F.col("in_b")).alias("all_matched"),
        F.max("in_a").alias("any_a"),
        F.max("in_b").alias("any_b"),
        F.collect_set("a_p").alias("landed_parts"),
        F.collect_set("b_p").alias("stored_parts"),
    )
    status = (
        F.when(~F.col("any_b"), "new")
        .when(~F.col("any_a"), "vanished")
        .when(F.col("all_matched"), "equal")
        .otherwise("changed")
    )
    return per_key.select(*[F.col(f"`{k}`") for k in keys], status.alias("status"), "landed_parts", "stored_parts")


def status_counts(status: Column) -> list[Column]:
    """One count per status, for ``DataFrame.observe``."""
    return [F.count(F.when(status == s, 1)).alias(s) for s in STATUSES]

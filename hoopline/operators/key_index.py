"""A key index written beside a stored table, so that a check for new keys reads only the files that may hold them.

Each file of the table gets index rows (file, bucket, lo, hi): the hash buckets of its normalised keys and the range
of those keys. A wanted key can be in a file only if the file has its bucket and the key lies in the file's range, so
only such files are read, and an exact anti join over their keys decides. The index is written in the table's folder
under ``_key_index``, which the parquet reader skips; it has at most ``INDEX_BUCKETS`` rows a file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.functions.text import strip_zeros

# Hash buckets a file's keys are spread over; a file's index has at most this many rows.
INDEX_BUCKETS = 4096


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(INDEX_BUCKETS))


def store_with_key_index(df: DataFrame, path: str, key: str, files: int, normalise=strip_zeros) -> None:
    """Write ``df`` as ``files`` parquet files ranged by ``key`` (so a file holds a narrow range), then its index.

    Rows with a null key are stored and never indexed: a null key is never wanted.
    """
    df.repartitionByRange(files, normalise(key)).sortWithinPartitions(normalise(key)).write.mode("overwrite").parquet(path)
    stored = df.sparkSession.read.parquet(path)
    keyed = stored.select(F.input_file_name().alias("file"), normalise(key).alias("key")).filter("key is not null")
    ranges = keyed.groupBy("file").agg(F.min("key").alias("lo"), F.max("key").alias("hi"))
    buckets = keyed.select("file", _bucket(F.col("key")).alias("bucket")).distinct()
    buckets.join(ranges, "file").write.mode("overwrite").parquet(f"{path}/_key_index")


@dataclass
class KeyCheck:
    """New keys, with the files the check read out of those stored."""

    rows: DataFrame
    files_read: list[str]
    files_total: int


def new_keys_indexed(
    source: DataFrame, path: str, key: str, target_key: str | None = None, normalise=strip_zeros
) -> KeyCheck:
    """Distinct source rows whose normalised key is in no file of the stored table at ``path``.

    Same rows as ``ingest.new_keys`` against the whole table. Source rows with a null key are kept (nothing
    holds a null), as there. The names of the candidate files go to the driver: they are the table's file list,
    which Spark's own listing holds there too.
    """
    spark = source.sparkSession
    index = spark.read.parquet(f"{path}/_key_index")
    wanted = source.withColumn(key, normalise(key)).distinct()
    probes = wanted.select(F.col(key).alias("key"), _bucket(F.col(key)).alias("bucket")).filter("key is not null")
    hits = (
        probes.join(index, "bucket")
        .filter((F.col("key") >= F.col("lo")) & (F.col("key") <= F.col("hi")))
        .select("file")
        .distinct()
    )
    files = sorted(r.file for r in hits.collect())
    total = index.select("file").distinct().count()
    if not files:
        return KeyCheck(wanted, [], total)
    present = spark.read.parquet(*files).select(normalise(target_key or key).alias(key)).distinct()
    return KeyCheck(wanted.join(present, key, "left_anti"), files, total)

"""Parquet-backed tables addressed by schema and name, CSV files, and schema alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What a writer may do when the table exists.
BEHAVIORS = {"replace": "overwrite", "append": "append", "fail": "errorifexists"}


def table_path(root: str, schema: str, table: str) -> str:
    return f"{root.rstrip('/')}/{schema}/{table}"


def read_table(
    spark: SparkSession, root: str, schema: str, table: str, columns: T.StructType | None = None
) -> DataFrame:
    """Whole table as a DataFrame; pruning and filters reach the Parquet scan."""
    reader = spark.read.schema(columns) if columns is not None else spark.read
    return reader.parquet(table_path(root, schema, table))


def table_exists(spark: SparkSession, root: str, schema: str, table: str) -> bool:
    """Whether the table has been written (any Hadoop file system)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(table_path(root, schema, table))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """SQL text over the named frames: ``run_sql(spark, "select * from {lines}", lines=df)``."""
    return spark.sql(query, **tables)


def write_table(
    df: DataFrame,
    root: str,
    schema: str,
    table: str,
    behavior: str,
    partition_by: list[str] | None = None,
) -> str:
    """Write a table; ``behavior`` is replace, append or fail. Returns its path."""
    if behavior not in BEHAVIORS:
        raise ValueError(f"behavior must be one of {sorted(BEHAVIORS)}, not {behavior!r}")
    writer = (by_partition(df, partition_by) if partition_by else df).write.mode(BEHAVIORS[behavior])
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    path = table_path(root, schema, table)
    writer.parquet(path)
    return path


def by_partition(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows gathered by table partition before a write: AQE merges small pieces and splits a partition
    that holds too much for one task, so each gets files of a sensible size."""
    return df.hint("rebalance", *keys)


def reload_partition(df: DataFrame, path: str, key: str) -> None:
    """Replace only those partitions of ``key`` that occur in ``df``; all others stay as they are."""
    (
        by_partition(df, [key])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(key)
        .parquet(path)
    )


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header row and a declared schema (no inference pass)."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(df: DataFrame, path: str, behavior: str = "replace") -> None:
    """CSV export with a header and no index."""
    df.write.mode(BEHAVIORS[behavior]).option("header", True).csv(path)


def align_to(df: DataFrame, target: T.StructType) -> DataFrame:
    """The columns, order and types of ``target``; columns that ``df`` lacks are an error."""
    missing = [f.name for f in target.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from the input: {missing}")
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in target.fields])

"""How the operators run over tables: reading, row-wise annotation, staged tables, partition counts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from hoopline.session import stage, staging_root

__all__ = ["BATCH_ROWS", "Columns", "annotate", "discard", "partitions", "slices", "stage", "table"]

#: Rows that reach Python in one Arrow batch; long texts make batches of many rows large.
BATCH_ROWS = 2000

Columns = dict[str, object]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def discard(*frames: DataFrame | None) -> None:
    """Delete the stored tables behind staged frames that nothing will read again.

    Only folders below the staging root are touched, so a frame read from the input is never deleted.
    """
    for df in frames:
        if df is None:
            continue
        files = df.inputFiles()
        if not files:
            continue
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(staging_root(spark))
        prefix = root.getFileSystem(conf).makeQualified(root).toString().rstrip("/") + "/"
        folder = files[0].rsplit("/", 1)[0]
        if folder.startswith(prefix) and "/" not in folder[len(prefix):]:
            target = jvm.org.apache.hadoop.fs.Path(folder)
            target.getFileSystem(conf).delete(target, True)


def partitions(spark: SparkSession) -> int:
    """How many buckets a packed shuffle deals its data to: the session's number, which grows with the data."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def annotate(
    df: DataFrame, text: str, keep: list[str], fn: Callable[[pa.Array], Columns], schema: str | T.StructType
) -> DataFrame:
    """The columns ``keep`` and those that ``fn`` makes of an array of texts, row by row, without a shuffle.

    ``keep`` must not have names of ``schema``; other columns of ``df`` are left out, so clashing names there do
    no harm.
    """
    made = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if clash := {f.name.lower() for f in made} & {k.lower() for k in keep}:
        raise ValueError(f"columns {sorted(clash)} are made here; rename them first")
    picked = df.select(*[df[k].alias(k) for k in keep], df[text].cast("string").alias("__text"))
    out = T.StructType([*(f for f in picked.schema if f.name != "__text"), *made])
    arrow = to_arrow_schema(made)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column(batch.schema.get_field_index("__text"))
            columns = fn(texts)
            held = [batch.column(i) for i in range(len(keep))]
            new = [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(held + new, names=[*keep, *arrow.names])

    return picked.mapInArrow(run, out)

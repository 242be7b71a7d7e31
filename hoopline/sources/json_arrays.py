"""Files holding one large JSON array of records, read in parallel by byte ranges with exact record starts.

``multiLine`` JSON reads a whole file in one task. Here Spark's text reader cuts each file at every ``}`` (a
one-byte delimiter that Hadoop's line reader splits exactly across file blocks), so a file's pieces spread over
as many tasks as it has blocks. A ``}`` inside a string also cuts, so where records begin depends on state carried
from the start of the file: whether the cut lies inside a string, and the bracket depth.

1. Each block (the pieces of one file split, in order) is walked from both possible string states, giving for each
   the string state and depth change at its end: its transition.
2. A scan over each file's blocks (one row per block) composes the transitions, so each block knows its exact start.
3. Each block is walked again from that start. A record is an object opened at depth 1 (directly inside the outer
   array) and closed back to it. Records whole within a block are emitted at once; parts of records that cross a
   block boundary are numbered by the file's running count of record starts and only those are shuffled and joined.

Valid JSON puts no raw control character and no ``\\}`` into a string, so a cut never falls inside an escape. Elements
of the outer array that are no objects are not records. The texts go to ``parse_documents``: a record that does not
fit the schema becomes a reject with its reason, never a lost row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoopline.session import stage

_OUTSIDE = re.compile(r'[{}\[\]"]')
_STRING_END = re.compile(r'(?:[^"\\]|\\.)*+"', re.S)


def walk(piece: str, in_string: bool, depth: int, closes: bool, events: list | None = None) -> tuple[bool, int]:
    """State after ``piece`` and, if ``closes``, its cutting ``}``. ``events`` gets (offset, +1 open / -1 close) of
    records: an element opened at depth 1, and its close back to depth 1 (offset ``len(piece) + 1`` for the cut)."""
    at, n = 0, len(piece)
    while at < n:
        if in_string:
            end = _STRING_END.match(piece, at)
            if not end:
                at = n
                break
            at, in_string = end.end(), False
            continue
        found = _OUTSIDE.search(piece, at)
        if not found:
            break
        ch, at = found.group(), found.end()
        if ch == '"':
            in_string = True
        elif ch in "{[":
            if depth == 1 and events is not None:
                events.append((found.start(), 1))
            depth += 1
        else:
            depth -= 1
            if depth == 1 and events is not None:
                events.append((at, -1))
    if closes and not in_string:
        depth -= 1
        if depth == 1 and events is not None:
            events.append((n + 1, -1))
    return in_string, depth


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.option("lineSep", "}")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_length").alias("length"),
            F.monotonically_increasing_id().alias("seq"),
            F.col("value").alias("piece"),
        )
    )


#: Bytes of record texts that a task gathers before it hands them on.
_OUT_BYTES = 1 << 20


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bool, bool]]:
    """(piece's row, whether it is the first of its (file, block), whether the last of its file), in order.

    One batch at a time, and one row ahead to see where a block ends: a block is never held as a whole.
    """
    held, key = None, None

    def last_of_file(r: dict) -> bool:
        return r["block"] + r["length"] >= r["size"]

    for batch in batches:
        names = batch.schema.names
        for values in zip(*(column.to_pylist() for column in batch.columns)):
            row = dict(zip(names, values))
            same = held is not None and (row["file"], row["block"]) == (held["file"], held["block"])
            if held is not None:
                yield held, (held["file"], held["block"]) != key, not same and last_of_file(held)
                key = (held["file"], held["block"])
            held = row
    if held is not None:
        yield held, (held["file"], held["block"]) != key, last_of_file(held)


_TRANSITION = "file string, block long, s_false boolean, d_false long, s_true boolean, d_true long"


def _transitions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, ends = [], {}
    for r, first, last in _rows(batches):
        if first:
            ends = {start: (start, 0) for start in (False, True)}
            out.append((r["file"], r["block"], ends))
        for start, (state, depth) in ends.items():
            ends[start] = walk(r["piece"] or "", state, depth, not last)
    names = ["file", "block", "s_false", "d_false", "s_true", "d_true"]
    types = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.bool_(), pa.int64()]
    rows = [(file, block, *ends[False], *ends[True]) for file, block, ends in out]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)


_STARTS = "file string, block long, in_string boolean, depth long"


def _compose(blocks):
    """Start state of each block of one file, from its blocks' transitions in order (a pandas frame)."""
    import pandas as pd

    blocks = blocks.sort_values("block")
    state, depth, rows = False, 0, []
    for r in blocks.itertuples():
        rows.append((r.file, r.block, state, depth))
        state, depth = (r.s_true, depth + r.d_true) if state else (r.s_false, depth + r.d_false)
    return pd.DataFrame(rows, columns=["file", "block", "in_string", "depth"])


_PARTS = "file string, block long, ordinal long, whole boolean, text string"


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records whole in a block, and the part in this block of each record crossing its edges.

    ``ordinal`` counts record starts in the block from 0; the part of a record opened in an earlier block has -1.
    """
    schema = pa.schema([
        ("file", pa.string()), ("block", pa.int64()), ("ordinal", pa.int64()), ("whole", pa.bool_()), ("text", pa.string())])
    out: dict[str, list] = {k: [] for k in schema.names}
    size = 0

    def emit(*values):
        nonlocal size
        for k, v in zip(out, values):
            out[k].append(v)
        size += len(values[-1])

    where, state, depth, ordinal, current, held = None, False, 0, -1, None, []
    for r, first, last in _rows(batches):
        if first:
            if current is not None:
                emit(*where, current, False, "".join(held))
            where, state, depth, ordinal = (r["file"], r["block"]), r["in_string"], r["depth"], -1
            current, held = (-1 if depth >= 2 else None), []
        piece = r["piece"] or ""
        text = piece if last else piece + "}"
        events: list = []
        state, depth = walk(piece, state, depth, not last, events)
        at = 0
        for offset, kind in events:
            if kind == 1:
                ordinal += 1
                current, held, at = ordinal, [], offset
            elif current is not None:
                held.append(text[at:offset])
                emit(*where, current, current >= 0, "".join(held))
                current, held = None, []
        if current is not None:
            held.append(text[at:])
        if size >= _OUT_BYTES:
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            out, size = {k: [] for k in schema.names}, 0
    if current is not None:
        emit(*where, current, False, "".join(held))
    yield pa.RecordBatch.from_pydict(out, schema=schema)


def read_json_arrays(spark: SparkSession, path: str) -> DataFrame:
    """The records of JSON-array files as texts: (file, ordinal, record), ordinal counting records from 0 per file."""
    pieces = _pieces(spark, path)
    transitions = pieces.mapInArrow(_transitions, _TRANSITION)
    # One row per file block: the scan of a file runs over its blocks, not its bytes.
    starts = stage(transitions.groupBy("file").applyInPandas(_compose, _STARTS), "json-array-starts")
    parts = stage(
        pieces.join(F.broadcast(starts), ["file", "block"]).sortWithinPartitions("seq").mapInArrow(_parts, _PARTS),
        "json-array-parts",
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        parts.groupBy("file", "block")
        .agg(F.coalesce(F.max(F.when(F.col("ordinal") >= 0, F.col("ordinal"))) + 1, F.lit(0)).alias("starts"))
        .withColumn("base", F.coalesce(F.sum("starts").over(earlier), F.lit(0)))
        .select("file", "block", "base")
    )
    numbered = parts.join(base, ["file", "block"]).withColumn(
        "ordinal", F.when(F.col("ordinal") >= 0, F.col("base") + F.col("ordinal")).otherwise(F.col("base") - 1)
    )
    whole = numbered.where("whole").select("file", "ordinal", F.col("text").alias("record"))
    joined = (
        numbered.where(~F.col("whole"))
        .groupBy("file", "ordinal")
        .agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("__parts"))
        .select("file", "ordinal", F.array_join(F.transform("__parts", lambda x: x["text"]), "").alias("record"))
    )
    return whole.unionByName(joined)


def read_array_records(spark: SparkSession, path: str, schema: T.StructType) -> "Landed":
    """Typed records of JSON-array files, with rejects (see ``payloads.parse_documents``): rows keep file and ordinal."""
    from hoopline.sources.payloads import Landed, parse_documents

    docs = parse_documents(read_json_arrays(spark, path), "record", schema, keep=["file", "ordinal"])
    return Landed(docs.rows.select("file", "ordinal", "doc.*"), docs.rejects, docs.counts)

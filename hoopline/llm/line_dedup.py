"""Fuzzy line dedup by MinHash: of lines that are alike, the corpus keeps one.

1. Each line with something in it gets a signature: for ``ROWS`` independent hash functions its character shingles are
   split into 16 bins, each bin keeping its least hash (a bin that stays empty borrows its neighbour's). Band b is bin
   b of all functions, for the first ``BANDS`` bins. Equal lines of a task are signed once.
2. Bands are dealt to buckets; lines that share a band are candidates. At a similarity of 0.8 a pair shares one of the
   ``BANDS`` with a probability of about 1 - (1 - 0.8**ROWS)**BANDS = 0.998.
3. Candidates are verified on their exact shingle sets, star by star and each pair once (see ``stars``), and linked
   lines become components by distributed union-find (see ``components``).
4. Of each component the first line is kept: the least by document id (nulls last), then place in the document.

Lines are known by a 64-bit hash of their bytes. Blank lines are neither compared nor removed. Shingles are ``SHINGLE``
characters of the line in lower case (A-Z); a shorter line is one shingle.

Cases: a null or empty text has no lines and stays as it is. Rows with the same id and text get the same result: a
line kept in one is kept in each. Rows with one id and different texts are told apart by their texts. Extra columns
are carried by ``drop_duplicate_lines`` and not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hoopline.llm.blocks import LOWER, SPACES, TextBlock, blocks, mix, prefix_hashes, span_hashes, window_hashes
from hoopline.llm.bloom import may_contain, membership
from hoopline.llm.frames import discard, partitions, slices, stage
from hoopline.llm.stars import Groups, linked_classes, parities

SHINGLE = 8
PERCENT = 80
BANDS = 12
ROWS = 4
HELD_BYTES = 16_000_000
BLOCK_BYTES = 1 << 18
_BINS = 16
_FILLED = ~SPACES
_EMPTY = np.uint32(0xFFFFFFFF)
_MULTIPLIERS = np.random.default_rng(99).integers(1, 1 << 63, ROWS, dtype=np.uint64) | np.uint64(1)


class Lines:
    """The lines of a block with something in them: spans, text, place in the text, key."""

    def __init__(self, block: TextBlock):
        data = block.data
        breaks = np.flatnonzero(data == 10) + 1
        starts = np.union1d(block.offsets[:-1], breaks)
        starts = starts[starts < len(data)]
        ends = np.append(starts[1:], len(data))[: len(starts)]
        ends = ends - (data[ends - 1] == 10) if len(starts) else ends
        text = np.searchsorted(block.offsets, starts, "right") - 1
        first = np.searchsorted(starts, block.offsets[:-1])
        place = np.arange(len(starts)) - first[text] if len(starts) else starts
        # a line's break is a space, so it may count with the line
        worded = np.logical_or.reduceat(_FILLED[data], starts) if len(starts) else np.zeros(0, bool)
        self.starts, self.ends, self.text, self.place = starts[worded], ends[worded], text[worded], place[worded]
        self.n = len(self.starts)
        self.keys = span_hashes(prefix_hashes(data), self.starts, self.ends)


def line_shingles(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(line, shingle hash) for every shingle of every line. Lines end where a character starts, or the data ends."""
    low = LOWER[data]
    sums = prefix_hashes(low)
    # all shingles of the block, those across line ends too; a line's own lie one after the other
    if (low < 0x80).all():
        hashes = window_hashes(sums, SHINGLE)
        first, counts = starts, ends - starts
    else:
        chars = np.append(np.flatnonzero((low & 0xC0) != 0x80), len(low))
        hashes = window_hashes(sums, SHINGLE, chars)
        first = np.searchsorted(chars, starts)
        counts = np.searchsorted(chars, ends) - first
    full = np.maximum(counts - (SHINGLE - 1), 0)
    owner = np.repeat(np.arange(len(starts)), full)
    at = np.repeat(first - (np.cumsum(full) - full), full)
    at += np.arange(len(at))
    short = np.flatnonzero(counts < SHINGLE)
    if not len(short):
        return owner, hashes[at]
    return np.concatenate((owner, short)), np.concatenate((hashes[at], span_hashes(sums, starts[short], ends[short])))


def shingle_sets(block: TextBlock) -> list[np.ndarray]:
    """The sorted distinct shingles of each text of a block of lines."""
    line, hashes = line_shingles(block.data, block.offsets[:-1], block.offsets[1:])
    order = np.argsort(line, kind="stable")
    bounds = np.searchsorted(line[order], np.arange(block.n + 1))
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        held = np.sort(hashes[order[a:b]])
        out.append(held[np.concatenate(([True], held[1:] != held[:-1]))[: len(held)]])
    return out


_LEND = np.uint32(0x9E3779B1)
# A value borrowed over d bins is v * _LEND**d + (1 + _LEND + ... + _LEND**(d-1)): marked with its distance, so that
# it does not equal the bin's own.
def _lend_tables() -> tuple[np.ndarray, np.ndarray]:
    power, total = [np.uint32(1)], [np.uint32(0)]
    with np.errstate(over="ignore"):
        for _ in range(_BINS):
            total.append(total[-1] + power[-1])
            power.append(power[-1] * _LEND)
    return np.array(power, np.uint32), np.array(total, np.uint32)


_POWER, _TOTAL = _lend_tables()


def _borrow(least: np.ndarray) -> np.ndarray:
    """Each empty bin takes the nearest filled bin to its right (cyclically), marked with the distance."""
    filled = least != _EMPTY
    some = np.flatnonzero(~filled.all(1))
    if len(some) < len(least):
        out = least.copy()
        if len(some):
            out[some] = _borrow(least[some])
        return out
    place = np.arange(2 * _BINS)
    nearest = np.where(np.concatenate((filled, filled), 1), place, 4 * _BINS)
    nearest = np.minimum.accumulate(nearest[:, ::-1], 1)[:, ::-1][:, :_BINS]
    distance = nearest - place[:_BINS]
    found = nearest < 2 * _BINS
    rows = np.arange(len(least))[:, None]
    lent = np.concatenate((least, least), 1)[rows, np.where(found, nearest, 0)]
    with np.errstate(over="ignore"):
        d = np.where(found, distance, 0)
        marked = lent * _POWER[d] + _TOTAL[d]
    return np.where(found, marked, _EMPTY).astype(np.uint32)


def band_hashes(line: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """(n, BANDS) hashes of the bands of ``n`` lines, from their shingles in any order."""
    out = np.zeros((n, _BINS), np.uint64)
    base = line * _BINS
    for k in range(ROWS):
        h = hashes * _MULTIPLIERS[k]
        bins = (h >> np.uint64(28)).view(np.int64)
        bins &= _BINS - 1
        bins += base
        h >>= np.uint64(32)
        least = np.full(n * _BINS, _EMPTY, np.uint32)
        np.minimum.at(least, bins, h.astype(np.uint32))
        least = _borrow(least.reshape(n, _BINS))
        out = mix(out ^ (least.astype(np.uint64) + np.uint64(k << 40)))
    return mix(out[:, :BANDS] ^ np.arange(BANDS, dtype=np.uint64) << np.uint64(56))


def _postings(buckets: int):
    """(bucket, band hashes, line keys) of each distinct line of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, keys, held = [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            key = np.concatenate(keys)
            order = np.argsort(key)
            first = order[np.concatenate(([True], key[order][1:] != key[order][:-1]))]
            band = np.concatenate(bands)[first].ravel()
            key = np.repeat(key[first], BANDS)
            bucket = (band >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            some = [k for k in range(buckets) if edges[k + 1] > edges[k]]
            columns = [pa.array(some, pa.int32())]
            # within a bucket the lower half and what the bucket leaves of the upper half tell bands apart
            for values in ((band & np.uint64(0xFFFFFFFF)).astype(np.uint32), key):
                columns.append(pa.array([values[order[edges[k] : edges[k + 1]]].tobytes() for k in some], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "band", "key"])

        for batch in slices(batches):
            for _, block in blocks(batch.column(0), BLOCK_BYTES):
                lines = Lines(block)
                order = np.argsort(lines.keys)
                first = order[np.concatenate(([True], lines.keys[order][1:] != lines.keys[order][:-1]))[: lines.n]]
                if not len(first):
                    continue
                line, hashes = line_shingles(block.data, lines.starts[first], lines.ends[first])
                bands.append(band_hashes(line, hashes, len(first)))
                keys.append(lines.keys[first])
                held += len(first) * (BANDS + 1) * 8
            if held > HELD_BYTES:
                yield from send()
                bands, keys, held = [], [], 0
        if keys:
            yield from send()

    return run


def _shared(group: pa.Table) -> pa.Table:
    """Bands that two or more different lines have, as (token, ref)."""
    bucket = group.column("bucket")[0].as_py()
    band = np.concatenate([np.frombuffer(x.as_py(), np.uint32) for x in group.column("band")])
    key = np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in group.column("key")])
    order = np.argsort(band)
    held = band[order]
    same = np.concatenate(([False], held[1:] == held[:-1], [False]))
    order = order[same[1:] | same[:-1]]
    order = order[np.lexsort((key[order], band[order]))]
    fresh = np.concatenate(([True], (band[order][1:] != band[order][:-1]) | (key[order][1:] != key[order][:-1])))
    order = order[fresh[: len(order)]]
    held = band[order]
    same = np.concatenate(([False], held[1:] == held[:-1], [False]))[: len(order) + 1]
    order = order[same[1:] | same[:-1]]
    token = (band[order].astype(np.int64) << 24) ^ bucket
    return pa.table({"token": pa.array(token, pa.int64()), "ref": pa.array(key[order], pa.int64())})


def _wanted_lines(wanted: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys, texts = [], []
            for _, block in blocks(batch.column(0), BLOCK_BYTES):
                lines = Lines(block)
                for i in np.flatnonzero(may_contain(wanted.value, lines.keys.view(np.int64))):
                    keys.append(int(lines.keys[i].view(np.int64)))
                    texts.append(block.data[lines.starts[i] : lines.ends[i]].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(texts, pa.string())], ["ref", "text"])

    return run


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with the size and parities of their sets."""
    for batch in slices(batches):
        sets = [s for _, block in blocks(batch.column(1), BLOCK_BYTES) for s in shingle_sets(block)]
        sizes = pa.array([len(s) for s in sets], pa.int64())
        odd = pa.array([parities(s) for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([*batch.columns, sizes, odd], ["ref", "text", "size", "parity"])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        ids, names = batch.column(0), batch.column(1)
        for row, block in blocks(batch.column(2), BLOCK_BYTES):
            lines = Lines(block)
            at = pa.array(lines.text + row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.keys.view(np.int64)), ids.take(at), names.take(at), pa.array(lines.place.astype(np.int32))],
                ["key", "doc_id", "name", "place"],
            )


def line_classes(documents: DataFrame, text: str = "text") -> DataFrame:
    """(node, root) for the keys of all lines that are alike to another line."""
    spark = documents.sparkSession
    texts = documents.select(documents[text].cast("string").alias("text"))
    packed = texts.mapInArrow(_postings(partitions(spark)), "bucket int, band binary, key binary")
    shared = stage(packed.groupBy("bucket").applyInArrow(_shared, "token long, ref long"), "shared-bands")

    def fetch(wanted: DataFrame) -> DataFrame:
        lines = texts.mapInArrow(_wanted_lines(membership(wanted)), "ref long, text string")
        lines = lines.groupBy("ref").agg(F.first("text").alias("text")).join(wanted, "ref", "left_semi")
        return lines.mapInArrow(_measured, "ref long, text string, size long, parity array<long>")

    # The first round compares all members of all groups, so their texts are read and measured once, for all rounds.
    held = stage(fetch(shared.select("ref").distinct()), "line-texts")
    classes = linked_classes(Groups(shared, PERCENT, F.col("ref"), fetch, texts=held), shingle_sets)
    discard(shared, held)
    return classes


def _kept_places(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, name, kept) by document: the places of the lines that stay; ``name`` tells texts of one id apart."""
    classes = line_classes(documents, text)
    rows = documents.select(
        documents[doc_id].alias("doc_id"), F.xxhash64(documents[text]).alias("name"), documents[text].cast("string").alias("text")
    )
    kind = dict(rows.dtypes)["doc_id"]
    found = rows.mapInArrow(_occurrences, f"key long, doc_id {kind}, name long, place int")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "place", "name")
    first = found.groupBy("key").agg(F.min(order).alias("first"))
    first = first.join(classes.withColumnRenamed("node", "key"), "key", "left")
    first = first.groupBy(F.coalesce("root", "key").alias("class")).agg(F.min("first").alias("first"))
    first = first.select("first.doc_id", "first.name", "first.place")
    return first.groupBy("doc_id", "name").agg(F.collect_list("place").alias("kept"))


def _rebuild(fields: list[str], text: str, report: bool):
    """Texts of the lines that stay; blank lines stay."""

    def one(value: str | None, kept: list[int] | None) -> tuple[int, int, str | None]:
        if not value:
            return 0, 0, value
        lines, stay = value.split("\n"), set(kept or ())
        out, n, n_kept = [], 0, 0
        for k, line in enumerate(lines):
            worded = bool(line.strip(" \t\n\v\f\r"))
            n += worded
            if not worded or k in stay:
                out.append(line)
                n_kept += worded
        return n, n_kept, "\n".join(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = [one(t, k) for t, k in zip(batch.column(fields.index(text)).to_pylist(), batch.column(len(fields)).to_pylist())]
            if report:
                digests = [hashlib.sha256((t or "").encode()).hexdigest() for _, _, t in made]
                new = [pa.array([m[k] for m in made], pa.int64()) for k in (0, 1)] + [pa.array(digests, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *new], ["doc_id", "n_lines", "n_kept", "kept_sha256"])
                continue
            held = [batch.column(i) for i in range(len(fields))]
            held[fields.index(text)] = pa.array([t for _, _, t in made], held[fields.index(text)].type)
            # a document of which no line stays is a copy of lines kept elsewhere
            stays = pa.array([not n or n_kept > 0 for n, n_kept, _ in made], pa.bool_())
            yield pa.RecordBatch.from_arrays(held, names=fields).filter(stays)

    return run


def _with_kept(documents: DataFrame, doc_id: str, text: str, columns: list) -> DataFrame:
    kept = _kept_places(documents, doc_id, text).select(
        F.col("doc_id").alias("__id"), F.col("name").alias("__name"), F.col("kept").alias("__kept")
    )
    same = documents[doc_id].eqNullSafe(F.col("__id")) & (F.xxhash64(documents[text]) == F.col("__name"))
    return documents.join(kept, same, "left").select(*columns, "__kept")


def deduplicated_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: n_lines (with something in them), n_kept of those, and kept_sha256 of the text left."""
    joined = _with_kept(documents, doc_id, text, [documents[doc_id].alias("doc_id"), documents[text].alias("text")])
    kind = dict(joined.dtypes)["doc_id"]
    schema = f"doc_id {kind}, n_lines long, n_kept long, kept_sha256 string"
    return joined.mapInArrow(_rebuild(["doc_id", "text"], "text", True), schema)


def drop_duplicate_lines(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents, all columns, with the lines that stay; those that lose every line go."""
    joined = _with_kept(documents, doc_id, text, [documents[c] for c in documents.columns])
    return joined.mapInArrow(_rebuild(documents.columns, text, False), T.StructType(documents.schema.fields))

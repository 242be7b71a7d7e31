"""Removal of long repeated byte strings, by suffixes sorted in range-partitioned buckets.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else in the corpus. Sorting every
suffix of a corpus would move hundreds of bytes for each of its bytes. Here only suffixes at anchors are sorted: of
the ``length - GRAM + 1`` grams that start in a window of ``length`` bytes, the one with the smallest hash (the first,
if tied) is the window's anchor. Equal windows have equal anchors at equal places, so two equal windows always meet
at suffixes with a common beginning, and each window belongs to exactly one anchor: nothing is lost.

1. Equal texts are made one, with their number (``copies``); a copied text is removed wholly, but still answers others.
2. Anchors are dealt to buckets by their leading bytes, at splitters taken from a sample. A bucket tells which
   anchors' grams occur twice. All others are settled: their windows occur once.
3. For the rest the text around the anchor (as far as its windows reach) goes to the bucket of its leading bytes.
   Contexts that are equal within a task are settled there, and one of them goes on: a hot passage is
   collapsed before the shuffle.
4. A bucket sorts the suffixes from the anchors on, and the reversed texts before them, by a multikey sort of eight
   bytes at a time, and takes the common prefixes of neighbours. Two windows at one offset are equal if they agree
   as far as they reach on both sides, so classes of equal prefixes on both sides give the repeated windows. Equal
   leading bytes always share a bucket (splitters are compared with the same leading bytes), so a match of
   ``GRAM`` bytes or more never spans a boundary between buckets; that is the comparison across boundaries.
5. Repeated windows are gathered by text, and the covered bytes cut out.

Cases: a null text is an empty one. Texts shorter than ``length`` lose nothing. Repeated rows, also of one id, are
copies of one text. Cutting may split a character, as bytes are counted; ``removed_text`` shows such cuts as U+FFFD.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopline.llm.blocks import TextBlock, blocks, mix, prefix_hashes, span_hashes
from hoopline.llm.frames import partitions, slices

LENGTH = 200
GRAM = 64
#: Texts whose anchors give the splitters.
SAMPLE_TEXTS = 2000
#: What a task holds of packed rows before it sends them on.
HELD_BYTES = 48_000_000
_PLACE_BITS = np.uint64(31)

_RESULT = "key binary, n_bytes long, n_removed long, n_spans long, kept binary"


def gram_size(length: int) -> int:
    return min(GRAM, max(8, length // 3))


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values) - width + 1
    filled = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    filled[: len(values)] = values
    rows = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


class Anchors:
    """The anchors of a block: text, place, first and last window that each serves, its gram's hash."""

    def __init__(self, block: TextBlock, length: int):
        n, data = len(block.data), block.data
        self.text = self.at = self.low = self.high = np.zeros(0, np.int64)
        self.gram = np.zeros(0, np.uint64)
        gram = gram_size(length)
        if n < length:
            return
        self.sums = prefix_hashes(data)
        starts = np.arange(n - gram + 1)
        hashes = span_hashes(self.sums, starts, starts + gram)
        ordered = (hashes >> _PLACE_BITS << _PLACE_BITS) | starts.astype(np.uint64)
        least = sliding_minimum(ordered, length - gram + 1)
        owner = np.repeat(np.arange(block.n), np.diff(block.offsets))
        window = np.flatnonzero(owner[: n - length + 1] == owner[length - 1 :])
        if not len(window):
            return
        at = (least[window] & np.uint64((1 << 31) - 1)).astype(np.int64)
        text = owner[window]
        fresh = np.concatenate(([True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])))
        first = np.flatnonzero(fresh)
        self.text, self.at, self.low = text[first], at[first], window[first]
        self.high = window[np.append(first[1:], len(window)) - 1]
        self.gram = hashes[self.at]

    def leading(self, data: np.ndarray) -> np.ndarray:
        """The first eight bytes of each anchor's suffix as a number."""
        out = np.zeros(len(self.at), np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | data[np.minimum(self.at + k, len(data) - 1)].astype(np.uint64)
        return out


def _texts(documents: DataFrame, text: str) -> DataFrame:
    """Distinct texts with their number; combined before the shuffle."""
    texts = documents.select(F.coalesce(documents[text].cast("string"), F.lit("")).alias("text"))
    return (
        texts.groupBy(F.unhex(F.md5(F.col("text").cast("binary"))).alias("key"))
        .agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    )


def splitters(documents: DataFrame, text: str, length: int) -> np.ndarray:
    """Leading bytes that cut the sampled anchors into even ranges, one fewer than there are partitions."""
    total = documents.count()
    share = max(1, total // SAMPLE_TEXTS)
    rows = documents.select(documents[text].alias("text")).filter(F.octet_length("text") >= length)
    sample = rows.filter(F.pmod(F.xxhash64("text"), F.lit(share)) == 0)
    rows = sorted(r[0] for r in sample.select(F.substring("text", 1, 20_000)).limit(4 * SAMPLE_TEXTS).collect())
    found = [Anchors(b, length).leading(b.data) for _, b in blocks(pa.array(rows, pa.string()))]
    values = np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)
    count = partitions(documents.sparkSession)
    if not len(values):
        return values
    return np.unique(values[(np.arange(1, count) * len(values)) // count])


def _column(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def _batch(columns: dict[str, list], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[k], t) for k, t in types.items()], names=list(types))


_GRAMS = {"bucket": pa.int32(), "keys": pa.binary(), "text": pa.binary(), "number": pa.binary(), "gram": pa.binary()}
_LIVE = {"key": pa.binary(), "numbers": pa.binary()}
_CONTEXTS = {"bucket": pa.int32(), "keys": pa.binary(), "fields": pa.binary(), "bytes": pa.binary()}
_SPANS = {"key": pa.binary(), "spans": pa.binary()}


def _ddl(types: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{k} {'int' if t == pa.int32() else 'binary'}" for k, t in types.items())


def _numbers(text: np.ndarray, texts: int) -> np.ndarray:
    """For rows in order of their text, the position of each among those of its text."""
    counts = np.bincount(text, minlength=texts)
    return np.arange(len(text)) - (np.cumsum(counts) - counts)[text]


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    held = bucket[order]
    edges = np.flatnonzero(np.concatenate(([True], held[1:] != held[:-1], [True]))) if len(held) else [0]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(held[a]), order[a:b]


def _emit_grams(cuts: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, held = [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            text, number, gram, bucket = (np.concatenate([p[i] for p in parts]) for i in range(4))
            table = np.array(keys, "V16")
            for b, rows in _by_bucket(bucket):
                own, new = np.unique(text[rows], return_inverse=True)
                yield _batch(
                    {
                        "bucket": [b],
                        "keys": [table[own].tobytes()],
                        "text": [new.astype(np.uint32).tobytes()],
                        "number": [number[rows].astype(np.uint32).tobytes()],
                        "gram": [gram[rows].tobytes()],
                    },
                    _GRAMS,
                )

        for batch in slices(batches):
            names = _column(batch, "key")
            for row, block in blocks(_column(batch, "text")):
                found = Anchors(block, length)
                if not len(found.at):
                    continue
                bucket = np.searchsorted(cuts, found.leading(block.data), "right")
                parts.append((found.text + len(keys), _numbers(found.text, block.n), found.gram, bucket))
                keys += names.slice(row, block.n).to_pylist()
                held += 16 * block.n + 24 * len(found.at)
                if held > HELD_BYTES:
                    yield from send()
                    keys, parts, held = [], [], 0
        if parts:
            yield from send()

    return run


def _live(group: pa.Table) -> pa.Table:
    """Of a bucket's anchors those whose gram occurs twice or more, by text."""
    rows = group.to_pylist()
    tables = [np.frombuffer(r["keys"], "V16") for r in rows]
    base = np.cumsum([0, *(len(t) for t in tables)])
    keys = np.concatenate(tables)
    text = np.concatenate([np.frombuffer(r["text"], np.uint32) + b for r, b in zip(rows, base)])
    number = np.concatenate([np.frombuffer(r["number"], np.uint32) for r in rows])
    gram = np.concatenate([np.frombuffer(r["gram"], np.uint64) for r in rows])
    order = np.argsort(gram)
    held = gram[order]
    same = np.concatenate(([False], held[1:] == held[:-1], [False]))
    live = np.sort(order[same[1:] | same[:-1]])
    out = {"key": [], "numbers": []}
    for t, at in _by_bucket(text[live]):
        out["key"].append(keys[t].tobytes())
        out["numbers"].append(number[live[at]].astype(np.uint32).tobytes())
    return pa.Table.from_batches([_batch(out, _LIVE)])


#: text, first window, windows, anchor's distance from the first window, bytes, whether it needs no answer
_FIELDS = np.dtype([("text", "u4"), ("low", "i8"), ("windows", "u2"), ("anchor", "u2"), ("size", "u4"), ("silent", "u1")])


def _emit_contexts(cuts: np.ndarray, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1)
        keys: list[bytes] = []
        fields, buckets, hashes, bodies, held = [], [], [], [], 0

        def send() -> Iterator[pa.RecordBatch]:
            record, bucket, digest = np.concatenate(fields), np.concatenate(buckets), np.concatenate(hashes)
            body, table = np.concatenate(bodies), np.array(keys, "V16")
            offset = np.cumsum(record["size"], dtype=np.int64) - record["size"]
            order = np.argsort(digest, kind="stable")
            same = np.concatenate(([False], digest[order][1:] == digest[order][:-1], [False]))
            again, copied = order[same[:-1]], order[same[1:] | same[:-1]]
            # equal contexts settle one another; the first of them goes on, to answer others
            settled = copied[record["silent"][copied] == 0]
            out = {"key": [], "spans": []}
            for t, at in _by_bucket(record["text"][settled]):
                out["key"].append(table[t].tobytes())
                rows = record[settled[at]]
                out["spans"].append(np.stack([rows["low"], rows["low"] + rows["windows"]], 1).astype("i8").tobytes())
            if out["key"]:
                yield _batch(
                    {"bucket": [-1 - k % 64 for k in range(len(out["key"]))], "keys": out["key"],
                     "fields": out["spans"], "bytes": [None] * len(out["key"])}, _CONTEXTS
                )
            record["silent"][copied] = 1
            going = np.ones(len(record), bool)
            going[again] = False
            going = np.flatnonzero(going)
            for b, rows in _by_bucket(bucket[going]):
                rows = going[rows]
                own, new = np.unique(record["text"][rows], return_inverse=True)
                sent = record[rows]
                sent["text"] = new
                raw = b"".join(body[o : o + s].tobytes() for o, s in zip(offset[rows], sent["size"]))
                yield _batch(
                    {"bucket": [b], "keys": [table[own].tobytes()], "fields": [sent.tobytes()],
                     "bytes": [pack.compress(raw)]}, _CONTEXTS
                )

        for batch in slices(batches):
            names, live, copies = (_column(batch, k) for k in ("key", "live", "copies"))
            for row, block in blocks(_column(batch, "text")):
                wanted = live.slice(row, block.n).to_pylist()
                found = Anchors(block, length)
                first = np.searchsorted(found.text, np.arange(block.n))
                picks = [first[i] + np.frombuffer(x, np.uint32) for i, w in enumerate(wanted) for x in w or ()]
                if not picks:
                    continue
                at = np.sort(np.concatenate(picks))
                low, high, anchor, text = found.low[at], found.high[at], found.at[at], found.text[at]
                size = high - low + length
                record = np.zeros(len(at), _FIELDS)
                record["text"], record["low"] = text + len(keys), low - block.offsets[text]
                record["windows"], record["anchor"], record["size"] = high - low + 1, anchor - low, size
                record["silent"] = np.asarray(copies.slice(row, block.n).to_pylist())[text] > 1
                fields.append(record)
                buckets.append(np.searchsorted(cuts, found.leading(block.data)[at], "right"))
                hashes.append(mix(span_hashes(found.sums, low, low + size) + (anchor - low).astype(np.uint64)))
                span = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
                bodies.append(block.data[span])
                keys += names.slice(row, block.n).to_pylist()
                held += len(span) + len(at) * _FIELDS.itemsize
                if held > HELD_BYTES:
                    yield from send()
                    keys, fields, buckets, hashes, bodies, held = [], [], [], [], [], 0
        if fields:
            yield from send()

    return run


def multikey_order(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of the strings data[start:start+size], and each one's common prefix with the one before it.

    A multikey quicksort with characters of eight bytes: strings are sorted by one character, and those that are
    equal so far by the next.
    """
    n = len(starts)
    order, group = np.arange(n), np.zeros(n, np.int64)
    prefix = np.zeros(n, np.int64)
    active, depth = np.arange(n), 0  # positions in sorted order that are not settled
    while len(active):
        rows = order[active]
        word = np.zeros(len(rows), np.uint64)
        left = np.clip(sizes[rows] - depth, 0, 8)
        for k in range(8):
            byte = data[np.minimum(starts[rows] + depth + k, len(data) - 1)].astype(np.uint64)
            word = (word << np.uint64(8)) | np.where(k < left, byte, np.uint64(0))
        by = np.lexsort((left, word, group[active]))
        rows, word, left, of = rows[by], word[by], left[by], group[active][by]
        order[active] = rows
        fresh = of[1:] != of[:-1]
        differs = (word[1:] != word[:-1]) | (left[1:] != left[:-1])
        common = np.zeros(len(rows) - 1, np.int64)
        odd = word[1:] ^ word[:-1]
        for k in range(8):
            common += (odd >> np.uint64(56 - 8 * k)) == 0
        common = np.minimum(common, np.minimum(left[1:], left[:-1]))
        here = active[1:][~fresh & differs]
        prefix[here] = depth + common[~fresh & differs]
        begins = np.concatenate(([True], fresh | differs))
        number = np.maximum.accumulate(np.where(begins, active, -1))
        group[active] = number
        ended = left < 8
        same = np.concatenate((~begins[1:], [False])) | ~begins
        # strings that end here and are equal have all of themselves in common
        done = ~begins & ended
        prefix[active[done]] = depth + left[done]
        active = active[same & ~ended]
        depth += 8
    return order, prefix


def repeated_windows(data, starts, sizes, anchor, windows, length: int) -> np.ndarray:
    """Which windows occur twice or more, as a flag for each window of each context in order."""
    first = np.cumsum(windows) - windows
    flags = np.zeros(int(windows.sum()), bool)
    if not len(starts):
        return flags
    right, right_prefix = multikey_order(data, starts + anchor, sizes - anchor)
    back = data[::-1]
    left, left_prefix = multikey_order(back, len(data) - starts - anchor, anchor)
    right_class, left_class = np.empty(len(starts), np.int64), np.empty(len(starts), np.int64)
    for before in range(int(anchor.max()) + 1):
        has = np.flatnonzero((before <= anchor) & (before > anchor - windows))
        if len(has) < 2:
            continue
        right_class[right] = np.cumsum(right_prefix < length - before)
        left_class[left] = np.cumsum(left_prefix < before)
        pair = right_class[has] * (len(starts) + 1) + left_class[has]
        order = np.argsort(pair)
        held = pair[order]
        same = np.concatenate(([False], held[1:] == held[:-1], [False]))
        hit = has[order[same[1:] | same[:-1]]]
        flags[first[hit] + anchor[hit] - before] = True
    return flags


def _repeats(length: int):
    def run(group: pa.Table) -> pa.Table:
        rows = group.to_pylist()
        if rows[0]["bucket"] < 0:  # settled before the shuffle
            made = {"key": [r["keys"] for r in rows], "spans": [r["fields"] for r in rows]}
            return pa.Table.from_batches([_batch(made, _SPANS)])
        unpack = zstandard.ZstdDecompressor()
        tables = [np.frombuffer(r["keys"], "V16") for r in rows]
        base = np.cumsum([0, *(len(t) for t in tables)])
        keys = np.concatenate(tables)
        records = [np.frombuffer(r["fields"], _FIELDS) for r in rows]
        record = np.concatenate(records)
        text = np.concatenate([r["text"].astype(np.int64) + b for r, b in zip(records, base)])
        data = np.concatenate([np.frombuffer(unpack.decompress(r["bytes"]), np.uint8) for r in rows])
        sizes, windows = record["size"].astype(np.int64), record["windows"].astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        flags = repeated_windows(data, starts, sizes, record["anchor"].astype(np.int64), windows, length)
        owner = np.repeat(np.arange(len(record)), windows)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows) + record["low"][owner]
        hit = np.flatnonzero(flags & (record["silent"][owner] == 0))
        out = {"key": [], "spans": []}
        if len(hit):
            joined = (owner[hit][1:] == owner[hit][:-1]) & (hit[1:] == hit[:-1] + 1)
            a = np.flatnonzero(np.concatenate(([True], ~joined)))
            b = np.append(a[1:], len(hit)) - 1
            low, high = place[hit[a]], place[hit[b]] + 1
            for t, at in _by_bucket(text[owner[hit[a]]]):
                out["key"].append(keys[t].tobytes())
                out["spans"].append(np.stack([low[at], high[at]], 1).astype("i8").tobytes())
        return pa.Table.from_batches([_batch(out, _SPANS)])

    return run


def _cut(length: int, keep_bytes: bool):
    """Counts and the remaining bytes, or their SHA-256 in hexadecimal, of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = {k: [] for k in ("key", "n_bytes", "n_removed", "n_spans", "kept")}
            for row in batch.to_pylist():
                raw = row["text"].encode()
                change = np.zeros(len(raw) + 1, np.int32)
                if row["copies"] > 1 and len(raw) >= length:
                    change[0] += 1
                for held in row["spans"] or ():
                    span = np.frombuffer(held, "i8").reshape(-1, 2)
                    np.add.at(change, span[:, 0], 1)
                    np.add.at(change, span[:, 1] + length - 1, -1)
                gone = np.cumsum(change[:-1]) > 0
                left = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out["key"].append(row["key"])
                out["n_bytes"].append(len(raw))
                out["n_removed"].append(int(gone.sum()))
                out["n_spans"].append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                out["kept"].append(left if keep_bytes else hashlib.sha256(left).hexdigest().encode())
            kinds = {k: pa.binary() if k in ("key", "kept") else pa.int64() for k in out}
            yield _batch(out, kinds)

    return run


def _deduplicated(documents: DataFrame, text: str, length: int, keep_bytes: bool) -> DataFrame:
    texts = _texts(documents, text)
    cuts = splitters(documents, text, length)
    long = texts.filter(F.octet_length("text") >= length)
    # all three steps read the same columns of the texts, so their one shuffle serves all
    grams = long.select("key", "text", "copies").mapInArrow(_emit_grams(cuts, length), _ddl(_GRAMS))
    live = grams.groupBy("bucket").applyInArrow(_live, _ddl(_LIVE))
    live = live.groupBy("key").agg(F.collect_list("numbers").alias("live"))
    # a left join, as an inner one would filter the texts below their shuffle and so need one of its own
    contexts = long.join(live, "key", "left").select("key", "text", "copies", "live")
    contexts = contexts.mapInArrow(_emit_contexts(cuts, length), _ddl(_CONTEXTS))
    spans = contexts.groupBy("bucket").applyInArrow(_repeats(length), _ddl(_SPANS))
    spans = spans.groupBy("key").agg(F.collect_list("spans").alias("spans"))
    joined = texts.join(spans, "key", "left").select("key", "text", "copies", "spans")
    return joined.mapInArrow(_cut(length, keep_bytes), _RESULT)


def suffix_dedup(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, keep_text: bool = False
) -> DataFrame:
    """One row per document: n_bytes, n_removed, n_spans and kept_sha256; with ``keep_text`` also kept_text."""
    if length < 16 or length > 60_000:
        raise ValueError("length is between 16 and 60,000 bytes")
    made = _deduplicated(documents, text, length, keep_text)
    key = F.unhex(F.md5(F.coalesce(documents[text].cast("string"), F.lit("")).cast("binary")))
    rows = documents.select(documents[doc_id].alias("doc_id"), key.alias("key")).join(made, "key", "left")
    digest = F.sha2("kept", 256) if keep_text else F.col("kept").cast("string")
    more = [F.decode("kept", "UTF-8").alias("kept_text")] if keep_text else []
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", digest.alias("kept_sha256"), *more)

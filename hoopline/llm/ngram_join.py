"""Near-duplicate documents by a Jaccard join on word n-grams, with prefix filtering.

A document's set is its distinct ``GRAM``-word shingles. Documents with equal sets are one class from the start.

1. All documents are counted into a table of fixed size (shingle hash -> bucket). Shingles are ordered by that count,
   rarest first, then by hash: an order that all documents share, whatever collides in the table.
2. Two sets that are similar enough share a shingle among the first few of each (its prefix). The prefixes are
   dealt to buckets by shingle; only shingles that two classes share stay, with the place in the class's order and the
   number of shared ones up to there.
3. Candidates pass these tests before texts are fetched: length; prefix (no place lies beyond what sets of these
   two sizes may leave out); position (shared ones so far plus the shorter rest); suffix (the least that two sets differ in, by
   their counts in ``PIVOTS`` hash ranges, and then by the parities of their counts in 1,024 ranges).
4. Candidates are compared star by star and verified once per pair on whole sets (see ``stars``). The first center
   of a shingle's classes is the one with the fewest unshared shingles: of near copies, the least edited.

Cases: null, empty and blank texts have an empty set and no links. With fewer words than ``GRAM`` the whole sequence is
the only shingle. Repeated rows are equal sets. Rows without an id take part; a component's id is its smallest id,
null if none has one. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.llm.blocks import LOWER, SPACES, TextBlock, Words, blocks, gram_hashes, mix
from hoopline.llm.bloom import may_contain, membership
from hoopline.llm.frames import partitions, slices, stage
from hoopline.llm.stars import Groups, linked_classes, parities

GRAM = 5
PERCENT = 80
SKETCH_BITS = 20
SLICES = 64
PIVOTS = 8
HELD_BYTES = 48_000_000
_NOTHING = 0
_ODD = 0x9E3779B97F4A7C15


def shingle_sets(block: TextBlock, size: int = GRAM) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data = LOWER[block.data]
    words = Words(block, SPACES, data)
    hashes = words.hashes(data)
    at = words.windows(size)
    grams = gram_hashes(hashes, at, size)
    bounds = np.searchsorted(at, words.bounds)
    out = []
    for i in range(block.n):
        if words.counts[i] >= size:
            held = np.sort(grams[bounds[i] : bounds[i + 1]])
            out.append(held[np.concatenate(([True], held[1:] != held[:-1]))])
        elif words.counts[i]:
            own = np.array([words.bounds[i]])
            out.append(gram_hashes(hashes, own, int(words.counts[i])))
        else:
            out.append(grams[:0])
    return out


def set_reference(held: np.ndarray) -> int:
    """A number for a set, equal for equal sets; ``_NOTHING`` for the empty one."""
    if not len(held):
        return _NOTHING
    total = np.bitwise_xor.reduce(mix(held), keepdims=True) + np.array([len(held)], np.uint64) * np.uint64(_ODD)
    return int(mix(total).view(np.int64)[0]) or 1


def prefix_size(n: int, percent: int) -> int:
    return n - -(-n * percent // 100) + 1


def _pivot_counts(held: np.ndarray) -> int:
    counts = np.minimum(np.bincount((held >> np.uint64(61)).astype(np.int64), minlength=PIVOTS), 255)
    return int(counts.astype(np.uint8).view(np.int64)[0])


_FIRST = ["doc_id", "n", "ref", "parity", "slice", "counts"]


def _ids_and_counts(size: int):
    """A row (doc_id, n, ref, parity) per document, then rows (slice, counts) of this task's count table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << SKETCH_BITS, np.int64)
        kind = None
        for batch in slices(batches):
            ids, n, refs, odd = batch.column(0), [], [], []
            kind = ids.type
            for _, block in blocks(batch.column(1)):
                sets = shingle_sets(block, size)
                n += [len(s) for s in sets]
                refs += [set_reference(s) for s in sets]
                odd += [parities(s) for s in sets]
                table += np.bincount(
                    (np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(table)
                )
            made = pa.array(n, pa.int64()), pa.array(refs, pa.int64()), pa.array(odd, pa.list_(pa.int64()))
            empty = pa.nulls(len(n), pa.int32()), pa.nulls(len(n), pa.binary())
            yield pa.RecordBatch.from_arrays([ids, *made, *empty], _FIRST)
        if kind is not None:
            parts = [zstandard.compress(p.tobytes(), 1) for p in table.reshape(SLICES, -1)]
            lost = [pa.nulls(SLICES, k) for k in (kind, pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(
                [*lost, pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], _FIRST
            )

    return run


def _add_counts(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(zstandard.decompress(c.as_py()), np.int64) for c in group.column("counts"))
    # an eighth of a power of two is as fine as the order needs
    ranks = np.floor(8 * np.log2(1 + total)).astype(np.uint8)
    return pa.table({"slice": group.column("slice").slice(0, 1), "ranks": pa.array([ranks.tobytes()], pa.binary())})


def _postings(ranks: Broadcast, buckets: int, percent: int, size: int):
    """Prefix shingles of each distinct set of the task, packed by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = np.frombuffer(ranks.value, np.uint8).astype(np.uint64)
        seen: set[int] = set()
        parts, held = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            token = np.concatenate([p[0] for p in parts])
            counts = np.array([len(p[0]) for p in parts])
            place = np.concatenate([np.arange(1, c + 1, dtype=np.uint32) for c in counts])
            ref, n, pivots = (np.repeat(np.array([p[k] for p in parts], np.int64), counts) for k in (1, 2, 3))
            bucket = (token >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
            rows = [order[a:b] for a, b in zip(edges[:-1], edges[1:])]
            some = [k for k, r in enumerate(rows) if len(r)]
            columns = [pa.array(some, pa.int32())]
            for values in (token, ref, n.astype(np.uint32), place, pivots):
                columns.append(pa.array([values[rows[k]].tobytes() for k in some], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "token", "ref", "n", "place", "pivots"])

        for batch in slices(batches):
            for _, block in blocks(batch.column(0)):
                for s in shingle_sets(block, size):
                    ref = set_reference(s)
                    if ref == _NOTHING or ref in seen:
                        continue
                    seen.add(ref)
                    key = rank[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)] << np.uint64(56) | s >> np.uint64(8)
                    first = np.argsort(key)[: prefix_size(len(s), percent)]
                    parts.append((s[first], ref, len(s), _pivot_counts(s)))
                    held += 32 * len(first)
            if held > HELD_BYTES:
                yield from send()
                parts, held = [], 0
        if parts:
            yield from send()

    return run


_SHARED = "token long, ref long, n int, place int, pivots long"


def _shared(group: pa.Table) -> pa.Table:
    """Of a bucket's postings those whose shingle two or more classes have."""
    columns = {}
    for name, kind in (("token", np.uint64), ("ref", np.int64), ("n", np.uint32), ("place", np.uint32), ("pivots", np.int64)):
        columns[name] = np.concatenate([np.frombuffer(x.as_py(), kind) for x in group.column(name)])
    token, ref = columns["token"], columns["ref"]
    order = np.argsort(token)
    held = token[order]
    same = np.concatenate(([False], held[1:] == held[:-1], [False]))
    order = order[same[1:] | same[:-1]]
    order = order[np.lexsort((ref[order], token[order]))]
    t, r = token[order], ref[order]
    fresh = np.concatenate(([True], (t[1:] != t[:-1]) | (r[1:] != r[:-1])))[: len(order)]
    order = order[fresh]
    held = token[order]
    same = np.concatenate(([False], held[1:] == held[:-1], [False]))[: len(order) + 1]
    order = order[same[1:] | same[:-1]]
    return pa.table(
        {
            "token": pa.array(token[order].view(np.int64)),
            "ref": pa.array(ref[order]),
            "n": pa.array(columns["n"][order].astype(np.int32)),
            "place": pa.array(columns["place"][order].astype(np.int32)),
            "pivots": pa.array(columns["pivots"][order]),
        }
    )


def needed(both: Column, percent: int) -> Column:
    """How many shingles two sets of ``both`` in all have to share."""
    return F.ceil(both * percent / (100 + percent))


def may_link(a: str, b: str, percent: int) -> Column:
    """The filters on two postings of one shingle, with the columns of ``_SHARED`` and ``shared``."""
    x = {k: F.col(f"{a}.{k}") for k in ("ref", "n", "place", "pivots", "shared")}
    y = {k: F.col(f"{b}.{k}") for k in ("ref", "n", "place", "pivots", "shared")}
    both = x["n"] + y["n"]
    length = F.least(x["n"], y["n"]) * 100 >= F.greatest(x["n"], y["n"]) * percent

    # what is shared lies at the first shared shingle or after it, in both sets
    shared = needed(both, percent)
    prefix = (x["place"] <= x["n"] - shared + 1) & (y["place"] <= y["n"] - shared + 1)
    overlap = F.least(x["shared"], y["shared"]) + F.least(x["n"] - x["place"], y["n"] - y["place"])
    position = overlap * (100 + percent) >= both * percent
    differ = reduce(
        lambda s, k: s
        + F.abs(F.shiftright(x["pivots"], 8 * k).bitwiseAND(255) - F.shiftright(y["pivots"], 8 * k).bitwiseAND(255)),
        range(PIVOTS),
        F.lit(0),
    )
    suffix = (both - differ) * (100 + percent) >= both * percent * 2
    return (x["ref"] != y["ref"]) & length & prefix & position & suffix


def _with_references(size: int, wanted: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            refs = [set_reference(s) for _, block in blocks(batch.column(0)) for s in shingle_sets(block, size)]
            refs = np.array(refs, np.int64)
            kept = pa.array(may_contain(wanted.value, refs))
            yield pa.RecordBatch.from_arrays([pa.array(refs), batch.column(0)], names=["ref", "text"]).filter(kept)

    return run


class NgramJoin:
    """The steps of the join over one table of documents."""

    def __init__(self, documents: DataFrame, doc_id: str, text: str, percent: int, size: int):
        self.spark = documents.sparkSession
        self.percent, self.size = percent, size
        self.rows = documents.select(documents[doc_id].alias("doc_id"), documents[text].cast("string").alias("text"))
        kind = dict(self.rows.dtypes)["doc_id"]
        first = self.rows.mapInArrow(
            _ids_and_counts(size), f"doc_id {kind}, n long, ref long, parity array<long>, slice int, counts binary"
        )
        first = stage(first, "shingle-counts")
        self.ids = first.filter("slice is null").select("doc_id", "n", "ref", "parity")
        ranks = first.filter("slice is not null").select("slice", "counts").groupBy("slice")
        ranks = ranks.applyInArrow(_add_counts, "slice int, ranks binary").collect()
        table = b"".join(bytes(r["ranks"]) for r in sorted(ranks)) or bytes(1 << SKETCH_BITS)
        self.ranks = self.spark.sparkContext.broadcast(table)

    def shared(self) -> DataFrame:
        packed = self.rows.select("text").mapInArrow(
            _postings(self.ranks, partitions(self.spark), self.percent, self.size),
            "bucket int, token binary, ref binary, n binary, place binary, pivots binary",
        )
        found = packed.groupBy("bucket").applyInArrow(_shared, _SHARED)
        # a prefix is a fifth of a set at most, so this window is bounded by the longest text
        found = found.selectExpr(
            "*", "cast(row_number() over (partition by ref order by place) as int) as shared",
            "cast(count(*) over (partition by ref) as int) as held",
        )
        return stage(found, "shared-shingles")

    def run(self) -> DataFrame:
        """(node, root) of every class that is linked with another."""
        percent, size = self.percent, self.size
        unshared = F.expr(f"n - cast(ceil(n * {percent} / 100) as int) + 1 - held")
        details = self.ids.filter(F.col("ref") != _NOTHING).groupBy("ref")
        groups = Groups(
            self.shared(), percent, F.struct(unshared, "ref"), self.texts, lambda x, y: may_link(x, y, percent),
            details.agg(F.first("n").alias("size"), F.first("parity").alias("parity")),
            F.col("place") <= F.col("n") - needed(F.col("n") + F.greatest("least_n", F.col("n") * percent / 100), percent) + 1,
        )
        return linked_classes(groups, lambda block: shingle_sets(block, size))

    def texts(self, wanted: DataFrame) -> DataFrame:
        """(ref, text) of the wanted classes, a text of each."""
        texts = self.rows.select("text").mapInArrow(
            _with_references(self.size, membership(wanted)), "ref long, text string"
        )
        # combined before the shuffle, so a class of many copies arrives as few rows
        return texts.groupBy("ref").agg(F.first("text").alias("text")).join(wanted, "ref", "left_semi")


def near_duplicates(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, size: int = GRAM
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest id of its component)."""
    if not 50 <= percent <= 100 or size < 1:
        raise ValueError("percent is between 50 and 100, and size at least 1")
    join = NgramJoin(documents, doc_id, text, percent, size)
    labels = join.run().select(F.col("node").alias("ref"), "root")
    rows = join.ids.join(labels, "ref", "left").withColumn("class", F.coalesce("root", "ref"))
    least = rows.groupBy("class").agg(F.min("doc_id").alias("least"))
    rows = rows.join(least, "class")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("least"))
    return rows.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))


def _chosen(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, key, copies) of one row of each component and of all rows with an empty set; ``key`` tells texts of one
    id apart, ``copies`` is how many rows have this id and this text (1 for empty sets, of which all stay)."""
    value = documents[text].cast("string")
    named = documents.select(
        F.struct(documents[doc_id].alias("doc_id"), F.xxhash64(value).alias("key")).alias("doc_id"), value.alias("text")
    )
    join = NgramJoin(named, "doc_id", "text", PERCENT, GRAM)
    labels = join.run().select(F.col("node").alias("ref"), "root")
    rows = join.ids.select("doc_id.doc_id", "doc_id.key", "n", "ref")
    copies = rows.filter("n > 0").groupBy("ref", "doc_id", "key").agg(F.count("*").alias("copies"))
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "ref", "key", "copies")
    first = copies.groupBy("ref").agg(F.min(order).alias("first")).join(labels, "ref", "left")
    first = first.groupBy(F.coalesce("root", "ref").alias("class")).agg(F.min("first").alias("first"))
    empty = rows.filter("n = 0").select("doc_id", "key", F.lit(1).cast("long").alias("copies")).distinct()
    return stage(first.select("first.doc_id", "first.key", "first.copies").unionByName(empty), "one-of-each")


def drop_near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents, all columns: exactly one row of each component stays, and every row with an empty set.

    The row that stays has the least id (nulls last), then the least set reference and text hash; of rows that have the same
    id and text, the one whose columns have the least hash. What else has its id plays no part.
    """
    chosen = _chosen(documents, doc_id, text).select(
        F.col("doc_id").alias("__id"), F.col("key").alias("__key"), F.col("copies").alias("__copies")
    )
    same = documents[doc_id].eqNullSafe(F.col("__id")) & (F.xxhash64(documents[text].cast("string")) == F.col("__key"))
    once = documents.join(chosen.filter("__copies = 1"), same, "left_semi")
    repeated = chosen.filter("__copies > 1")
    if repeated.isEmpty():
        return once
    row = F.struct(*[documents[c].alias(c) for c in documents.columns])
    rows = documents.join(repeated, same).select("__id", "__key", row.alias("row"))
    one = rows.groupBy("__id", "__key").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return once.unionByName(one.select("row.*"))

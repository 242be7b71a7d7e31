"""Linking members of groups without pairing all members of a group.

Groups are rows (token, ref, ...): refs that share a token are candidates for a link. Only components are asked for.
Each group's members are compared with one member first; what is linked needs no further pair. Members that are
still apart are compared with another member in one more round, and what is apart then is compared pair by
pair. So every pair of a group that ends in two components was either compared or ruled out by the filters.

Pairs are verified once each on whole texts: rows are dealt by center, a center's text is read once and its members
stream past. A center with many members is copied to several tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.llm.blocks import TextBlock, blocks
from hoopline.llm.components import connected_components
from hoopline.llm.frames import discard, partitions, slices, stage

STAR_ROUNDS = 2
#: Members compared with one copy of a center.
MEMBERS_PER_CENTER = 2000
#: 1,024 hash ranges.
PARITY_WORDS = 16
_PARITY_SHIFT = 54

Sets = Callable[[TextBlock], list[np.ndarray]]
Filter = Callable[[str, str], Column]


def _verify(sets: Sets, percent: int):
    """Rows ordered by (center, salt, kind): a center's text, then its members. Linked pairs come out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        center, base = None, np.zeros(0, np.uint64)
        for batch in slices(batches):
            centers, kinds, refs = (batch.column(k).to_pylist() for k in (0, 2, 3))
            a, b, row = [], [], 0
            for _, block in blocks(batch.column(4)):
                for held in sets(block):
                    if kinds[row] == 0:
                        center, base = centers[row], held
                    elif centers[row] == center and len(base):
                        place = np.minimum(np.searchsorted(base, held), len(base) - 1)
                        common = int((base[place] == held).sum())
                        if 100 * common >= percent * (len(base) + len(held) - common):
                            a.append(center)
                            b.append(refs[row])
                    row += 1
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """(a, b) for those of ``pairs`` (center, ref) whose sets reach a Jaccard similarity of ``percent``."""
    salts = pairs.groupBy("center").agg(F.ceil(F.count("*") / MEMBERS_PER_CENTER).alias("salts"))
    members = pairs.join(salts, "center").join(texts, "ref").select(
        "center", F.pmod(F.xxhash64("ref"), "salts").cast("int").alias("salt"), F.lit(1).alias("kind"), "ref", "text"
    )
    centers = salts.join(texts, F.col("center") == F.col("ref")).select(
        "center", F.explode(F.sequence(F.lit(0), (F.col("salts") - 1).cast("int"))).alias("salt"),
        F.lit(0).alias("kind"), "ref", "text",
    )
    rows = members.unionByName(centers).repartition(partitions(pairs.sparkSession), "center", "salt")
    rows = rows.sortWithinPartitions("center", "salt", "kind")
    return rows.mapInArrow(_verify(sets, percent), "a long, b long")


def parities(held: np.ndarray) -> list[int]:
    """For each of 64 * PARITY_WORDS hash ranges whether the set has an odd number of members there."""
    counts = np.bincount((held >> np.uint64(_PARITY_SHIFT)).astype(np.int64), minlength=64 * PARITY_WORDS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64).tolist()


def may_be_close(a: str, b: str, percent: int) -> Column:
    """Sets differ in at least as many members as there are hash ranges with an odd number of them in just one."""
    differ = reduce(
        lambda s, k: s + F.bit_count(F.col(f"{a}.parity")[k].bitwiseXOR(F.col(f"{b}.parity")[k])),
        range(PARITY_WORDS), F.lit(0),
    )
    sizes = F.col(f"{a}.size"), F.col(f"{b}.size")
    both = sizes[0] + sizes[1]
    length = F.least(*sizes) * 100 >= F.greatest(*sizes) * percent
    return length & ((both - differ) * (100 + percent) >= both * percent * 2)


def close_pairs(pairs: DataFrame, details: DataFrame, percent: int) -> DataFrame:
    """The pairs (center, ref) that sizes and parities do not rule out."""
    known = F.struct("size", "parity")
    x = details.select(F.col("ref").alias("center"), known.alias("x"))
    y = details.select("ref", known.alias("y"))
    return pairs.join(x, "center").join(y, "ref").filter(may_be_close("x", "y", percent)).select("center", "ref")


@dataclass
class Groups:
    """Candidate groups and what is known of their members.

    ``rows``: (token, ref, further columns for ``may_link``). ``first_rank``: the member with the least is a group's first
    center. ``fetch`` takes refs (one column, distinct) and returns (ref, text) for them. ``details``: (ref, size, parity)
    for a second filter on pairs (see ``may_be_close``); where it is None, ``fetch`` returns these columns too.
    """

    rows: DataFrame
    percent: int
    first_rank: Column
    fetch: Callable[[DataFrame], DataFrame]
    may_link: Filter = lambda x, y: F.lit(True)
    details: DataFrame | None = None
    #: Whether a member may have a partner in its group, from the least ``n`` of the group, ``least_n``.
    reachable: Column | None = None
    #: What ``fetch`` returns for all refs, stored by the caller: then no round fetches.
    texts: DataFrame | None = None

    def star(self, rows: DataFrame, step: int) -> DataFrame:
        """Pairs (center, ref) of one member of each group with the others."""
        later = "root" in rows.columns
        members = F.struct(*[c for c in rows.columns if c != "token"])
        rank = F.struct(F.xxhash64("token", "ref", F.lit(step)), "ref") if later else self.first_rank
        centers = rows.groupBy("token").agg(F.min_by(members, rank).alias("x"))
        paired = rows.select("token", members.alias("y")).join(centers, "token").filter(self._allowed(later))
        pairs = paired.select(F.col("x.ref").alias("center"), F.col("y.ref").alias("ref")).distinct()
        return pairs if self.details is None else close_pairs(pairs, self.details, self.percent)

    def all_pairs(self, rows: DataFrame, details: DataFrame) -> DataFrame:
        """Pairs of members that are still apart; both filters are part of the join."""
        rows = rows.join(details.select("ref", "size", "parity"), "ref")
        members = F.struct(*[c for c in rows.columns if c != "token"])
        one, other = (rows.select("token", members.alias(k)) for k in "xy")
        met = self._allowed("root" in rows.columns) & (F.col("x.ref") < F.col("y.ref"))
        met &= may_be_close("x", "y", self.percent)
        paired = one.join(other, (one["token"] == other["token"]) & met)
        return paired.select(F.col("x.ref").alias("center"), F.col("y.ref").alias("ref")).distinct()

    def _allowed(self, labelled: bool) -> Column:
        differ = F.col("x.root") != F.col("y.root") if labelled else F.lit(True)
        return (F.col("x.ref") != F.col("y.ref")) & self.may_link("x", "y") & differ


    def apart(self, rows: DataFrame, labels: DataFrame) -> DataFrame:
        """The groups whose members are in two components or more, with each member's root."""
        rows = rows.drop("root").join(labels.withColumnRenamed("node", "ref"), "ref", "left")
        rows = _split(rows.withColumn("root", F.coalesce("root", "ref")))
        if self.reachable is None:
            return rows
        least = rows.groupBy("token").agg(F.min("n").alias("least_n"))
        return _split(rows.join(least, "token").filter(self.reachable).drop("least_n"))


def _split(rows: DataFrame) -> DataFrame:
    roots = rows.groupBy("token").agg(F.min("root").alias("least"), F.max("root").alias("most"))
    return rows.join(roots.filter("least <> most").select("token"), "token", "left_semi")


def linked_classes(groups: Groups, sets: Sets) -> DataFrame:
    """(node, root) for every ref that is linked with another, directly or through others."""
    rows, links, tested, labels = groups.rows, None, None, None
    for step in range(STAR_ROUNDS + 1):
        if labels is not None:
            before = rows if rows is not groups.rows else None  # the caller's rows are the caller's to delete
            rows = stage(groups.apart(rows, labels), "apart")
            discard(before)
        texts = groups.texts
        details = groups.details
        if step < STAR_ROUNDS:
            pairs = groups.star(rows, step)
        else:
            if details is None:
                texts = details = texts or stage(groups.fetch(rows.select("ref").distinct()), "texts")
            pairs = groups.all_pairs(rows, details)
        if tested is not None:
            pairs = pairs.join(tested, ["center", "ref"], "left_anti")
        pairs = stage(pairs, "candidates")
        if pairs.isEmpty():
            continue  # the filters or earlier rounds leave this round nothing; the last one misses nothing
        if texts is None:
            refs = pairs.select("ref").union(pairs.select("center")).distinct()
            texts = stage(groups.fetch(refs), "texts")
        left = pairs if details is not None else close_pairs(pairs, texts, groups.percent)
        found = stage(verified(left, texts.select("ref", "text"), sets, groups.percent), "links")
        if texts is not groups.details and texts is not groups.texts:
            discard(texts)
        links = found if links is None else links.unionByName(found)
        turned = pairs.unionByName(pairs.select(F.col("ref").alias("center"), F.col("center").alias("ref")))
        tested = turned if tested is None else tested.unionByName(turned)
        before, labels = labels, connected_components(links)  # stored there
        discard(before)
    if labels is None:
        return rows.sparkSession.createDataFrame([], "node long, root long")
    return labels

"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items and documents are lower-cased (A-Z) and cut into words. One automaton holds every run of words of every item.
A document's words are fed to it; the state and the length of the longest match that ends at each word say which
windows of items end there. A window is ``window`` consecutive words of an item, or all words of a shorter one. Words
inside an occurrence of a window are hit.

Only stretches of words whose neighbouring pairs all occur in items can hold a window; they are found with array
operations for a block of texts, and only they are fed to the automaton word by word.

Items are gathered in blocks of at most ``BLOCK_CHARS`` characters, each broadcast by itself, so what a worker holds
at once is bounded. With more than one block, all blocks see all documents and their hits are joined per text.

Cases: null, empty and blank texts have no words, no hits and no items. Items without words match nothing. Items
with one id count once. An item without an id has its words hit but is not counted or listed. Rows are judged one by
one, so repeated rows and other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hoopline.llm.blocks import LOWER, NON_WORD, TextBlock, Words, blocks
from hoopline.llm.frames import Columns, annotate, slices

WINDOW = 10
BLOCK_CHARS = 16_000_000
#: Documents with more of their words hit are dropped whole; of others the hit spans are cut out.
MAX_COVERED_PERCENT = 60

SCHEMA = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


class SuffixAutomaton:
    """Every run of words of the items, with the windows that end in each state.

    ``steps[s]`` maps a word to the next state, ``link[s]`` is the state of the longest suffix that other words can
    precede, ``length[s]`` the longest run that ends in ``s``.
    """

    def __init__(self) -> None:
        self.steps: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.windows: dict[int, list[tuple[int, str | None]]] = {}
        self.nearest: list[int] = []

    def _state(self, length: int, link: int, steps: dict[int, int]) -> int:
        self.steps.append(steps)
        self.length.append(length)
        self.link.append(link)
        return len(self.steps) - 1

    def _split(self, at: int, word: int, target: int) -> int:
        """The state for the run of ``at`` followed by ``word``, taken out of ``target`` if that holds longer ones."""
        if self.length[target] == self.length[at] + 1:
            return target
        short = self._state(self.length[at] + 1, self.link[target], dict(self.steps[target]))
        self.link[target] = short
        while at >= 0 and self.steps[at].get(word) == target:
            self.steps[at][word] = short
            at = self.link[at]
        return short

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            known = self.steps[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new, at = self._state(self.length[last] + 1, 0, {}), last
            while at >= 0 and word not in self.steps[at]:
                self.steps[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, self.steps[at][word])
            last = new

    def mark(self, words: list[int], size: int, item: str | None) -> None:
        """Note at their states the windows of an item that was added."""
        size, state = min(size, len(words)), 0
        for i, word in enumerate(words, 1):
            state = self.steps[state][word]
            while i >= size and self.length[self.link[state]] >= size:
                state = self.link[state]
            if i >= size and (size, item) not in (held := self.windows.setdefault(state, [])):
                held.append((size, item))

    def finish(self) -> None:
        """For each state the nearest one up the links, itself included, at which a window ends."""
        self.nearest = [-1] * len(self.steps)
        for s in sorted(range(1, len(self.steps)), key=self.length.__getitem__):
            self.nearest[s] = s if s in self.windows else self.nearest[self.link[s]]

    def scan(self, words: list[int]) -> Iterator[tuple[int, int, str | None]]:
        """(last word, window size, item) of every window that occurs in ``words``."""
        state = matched = 0
        for i, word in enumerate(words):
            while state and word not in self.steps[state]:
                state = self.link[state]
                matched = self.length[state]
            if word in self.steps[state]:
                state = self.steps[state][word]
                matched += 1
            at = self.nearest[state] if state else -1
            while at > 0:
                for size, item in self.windows[at]:
                    if size <= matched:
                        yield i, size, item
                at = self.nearest[self.link[at]] if self.link[at] > 0 else -1


class Items:
    """The automaton of some items, and the tables that find stretches worth feeding to it."""

    def __init__(self, rows: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.window = window
        texts = pa.array([text for _, text in rows], pa.string())
        hashed: list[np.ndarray] = []
        for _, block in blocks(texts):
            data = LOWER[block.data]
            words = Words(block, NON_WORD, data)
            hashes = words.hashes(data)
            hashed += [hashes[words.bounds[i] : words.bounds[i + 1]] for i in range(block.n)]
        self.vocabulary = np.unique(np.concatenate(hashed)) if hashed else np.zeros(0, np.uint64)
        ids = [np.searchsorted(self.vocabulary, h) for h in hashed]
        self.pairs = np.unique(np.concatenate([x[:-1] * len(self.vocabulary) + x[1:] for x in ids if len(x)] or [[]]))
        self.pairs = self.pairs.astype(np.int64)
        self.shortest = min((min(window, len(x)) for x in ids if len(x)), default=0)
        self.automaton = SuffixAutomaton()
        for x in ids:
            self.automaton.add(x.tolist())
        for (item, _), x in zip(rows, ids, strict=True):
            if len(x):
                self.automaton.mark(x.tolist(), window, item)
        self.automaton.finish()

    def find(self, words: Words, hashes: np.ndarray) -> tuple[np.ndarray, dict[int, set[str]]]:
        """Which words are hit, and the items whose windows occur in each text."""
        found: dict[int, set[str]] = {}
        hit = np.zeros(words.n, bool)
        if not self.shortest or not words.n:
            return hit, found
        ids = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[ids] == hashes
        joined = known[1:] & known[:-1] & (words.owner[1:] == words.owner[:-1])
        near = np.flatnonzero(joined)
        key = ids[near] * len(self.vocabulary) + ids[near + 1]
        if len(self.pairs):
            place = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined[near] = self.pairs[place] == key
        else:
            joined[:] = False
        begins = np.flatnonzero(known & ~np.concatenate(([False], joined)))
        ends = np.flatnonzero(known & ~np.concatenate((joined, [False]))) + 1
        long = ends - begins >= self.shortest
        spans: dict[int, list[int]] = {}
        for begin, end in zip(begins[long].tolist(), ends[long].tolist(), strict=True):
            owner = int(words.owner[begin])
            for last, size, item in self.automaton.scan(ids[begin:end].tolist()):
                spans.setdefault(size, []).append(begin + last + 1 - size)
                if item is not None:
                    found.setdefault(owner, set()).add(item)
        for size, at in spans.items():
            hit |= words.cover(np.array(at), size)
        return hit, found


def broadcast_items(benchmark: DataFrame, item_id: str, text: str) -> list[Broadcast]:
    """The items in blocks of bounded size. Blocks are cut by a hash of the text, so equal texts share one."""
    spark = benchmark.sparkSession
    rows = benchmark.select(benchmark[item_id].cast("string").alias("id"), benchmark[text].alias("text")).distinct()
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, math.ceil(total / BLOCK_CHARS))
    out = []
    for k in range(count):
        part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(count)) == k)
        out.append(spark.sparkContext.broadcast((uuid.uuid4().hex, [tuple(r) for r in part.collect()])))
    return out


_BUILT: dict[tuple[str, int], Items] = {}


def _items(block: Broadcast, window: int) -> Items:
    """A worker keeps the automaton of one block: with a single block it is built once."""
    name, rows = block.value
    key = (name, window)
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Items(rows, window)
    return _BUILT[key]


def _scan(block: TextBlock, items: list[Broadcast], window: int) -> tuple[Words, np.ndarray, list[set[str]]]:
    data = LOWER[block.data]
    words = Words(block, NON_WORD, data)
    hashes = words.hashes(data)
    hit, found = np.zeros(words.n, bool), [set() for _ in range(block.n)]
    for one in items:
        more, named = _items(one, window).find(words, hashes)
        hit |= more
        for i, names in named.items():
            found[i] |= names
    return words, hit, found


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """One row per document: its words, the words hit, and the items found, as a count and a digest of their ids."""
    items = broadcast_items(benchmark, item_id, item_text)

    def report(texts: pa.Array) -> Columns:
        out: Columns = {f.split()[0]: [] for f in SCHEMA.split(", ")}
        for _, block in blocks(texts):
            words, hit, found = _scan(block, items, window)
            n_hit = np.bincount(words.owner[hit], minlength=block.n)
            out["n_words"] += words.counts.tolist()
            out["n_hit"] += n_hit.tolist()
            out["contaminated"] += (n_hit > 0).tolist()
            out["n_items"] += [len(x) for x in found]
            out["items_sha256"] += [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in found]
        return out

    return annotate(documents, text, [doc_id], report, SCHEMA)


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    max_covered_percent: int = MAX_COVERED_PERCENT,
) -> DataFrame:
    """Documents without what they share with test items, all columns kept.

    A document of whose words more than ``max_covered_percent`` are hit goes. In others each span of hit words is
    cut out, from its first word's start to its last word's end. Texts without a hit stay as they are.
    """
    items = broadcast_items(benchmark, item_id, item_text)
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column(at)
            keep, changed = np.ones(batch.num_rows, bool), {}
            for row, block in blocks(column):
                words, hit, _ = _scan(block, items, window)
                n_hit = np.bincount(words.owner[hit], minlength=block.n)
                keep[row : row + block.n] = 100 * n_hit <= max_covered_percent * words.counts
                for i in np.flatnonzero(n_hit):
                    changed[row + int(i)] = _cut(block, words, hit, int(i))
            if changed:
                texts = column.to_pylist()
                for i, new in changed.items():
                    texts[i] = new
                batch = batch.set_column(at, batch.schema.field(at), pa.array(texts, column.type))
            yield batch.filter(pa.array(keep))

    return documents.mapInArrow(run, documents.schema)


def _cut(block: TextBlock, words: Words, hit: np.ndarray, i: int) -> str:
    own = slice(words.bounds[i], words.bounds[i + 1])
    flags = np.concatenate(([False], hit[own], [False]))
    begins, ends = np.flatnonzero(flags[1:] & ~flags[:-1]), np.flatnonzero(~flags[1:] & flags[:-1]) - 1
    at, parts = block.offsets[i], []
    for begin, end in zip(words.starts[own][begins], words.ends[own][ends], strict=True):
        parts.append(block.data[at:begin].tobytes())
        at = end
    parts.append(block.data[at : block.offsets[i + 1]].tobytes())
    return b"".join(parts).decode()

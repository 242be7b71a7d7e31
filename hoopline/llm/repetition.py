"""Quality rules: base counts of a text, and repetition by a suffix array over its words.

The suffixes of a text's words are sorted by prefix doubling. Neighbours in that order share their longest common
prefix with one another, so the deeper of a suffix's two neighbouring prefixes is the longest repeat that starts
there (the deepest longest-common-prefix interval that holds it). Repeats of at least ``min_repeat`` words are
maximal repeated spans; their union is the covered part of the text. A text is rejected if the covered part of its
words is over ``max_covered`` percent, or its longest repeat is over ``max_repeat`` words.

A whole block of texts is sorted at once. Suffixes leave the sort as soon as they are unique, and ranks are kept
by doubling step, from which the common prefix of two neighbours is read off.

Null, empty and blank texts have no words: all counts are 0, ``base_failed`` is true and ``kept`` false. Rows are
judged one by one, so repeated rows, ids and other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from hoopline.llm.blocks import SPACES, TextBlock, Words, blocks, gram_hashes, mix, prefix_hashes, repeated, span_hashes
from hoopline.llm.frames import Columns, annotate

MIN_WORDS = 50
MAX_REPEAT_WORDS_PERCENT = 50
MIN_REPEAT = 8
MAX_COVERED_PERCENT = 40
MAX_REPEAT = 150

SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, n_covered_words long"
)
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def longest_repeats(words: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each word, how many words from it on occur again in its text (overlaps count).

    ``words``: one number per word, equal for equal words; ``owner``: the text of each, ascending.
    """
    n = len(words)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    _, number, size = np.unique(
        mix(words ^ mix(owner.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True
    )
    # a rank is the place in sorted order at which the suffixes with this beginning start; 0 is the end of a text
    rank = 1 + (np.cumsum(size) - size)[number]
    levels, length, pairs = [rank], 1, []
    active = np.flatnonzero(size[number] > 1)
    while len(active):
        after = np.zeros(len(active), np.int64)
        inside = np.flatnonzero(active + length < n)
        inside = inside[owner[active[inside]] == owner[active[inside] + length]]
        after[inside] = rank[active[inside] + length]
        order = np.lexsort((after, rank[active]))
        at, low, high = active[order], after[order], rank[active][order]
        joined = high[1:] == high[:-1]
        split = low[1:] != low[:-1]
        # neighbours that agree at this length but not at twice the length: their common prefix ends in between
        pairs.append((at[:-1][joined & split], at[1:][joined & split], len(levels) - 1))
        place = np.arange(len(at))
        old = np.maximum.accumulate(np.where(np.concatenate(([True], ~joined)), place, 0))
        new = np.maximum.accumulate(np.where(np.concatenate(([True], ~joined | split)), place, 0))
        rank = rank.copy()
        rank[at] = high + new - old
        levels.append(rank)
        length *= 2
        active = np.sort(at[np.bincount(new, minlength=len(at))[new] > 1])
    for left, right, level in pairs:
        common = _common(left, right, level, levels, owner, n)
        np.maximum.at(out, left, common)
        np.maximum.at(out, right, common)
    return out


def _common(left, right, level, levels, owner, n):
    """Words that two suffixes share, known to agree on the first 2**level and not on twice as many."""
    shared = np.full(len(left), 1 << level, np.int64)
    for k in range(level - 1, -1, -1):
        a, b = left + shared, right + shared
        inside = (a < n) & (b < n)
        a, b = np.where(inside, a, 0), np.where(inside, b, 0)
        inside &= (owner[a] == owner[left]) & (owner[b] == owner[right]) & (levels[k][a] == levels[k][b])
        shared += inside.astype(np.int64) << k
    return shared


def measure(block: TextBlock) -> Columns:
    words = Words(block, SPACES)
    sums = prefix_hashes(block.data)
    hashes = span_hashes(sums, words.starts, words.ends)
    first_byte = (block.data & 0xC0) != 0x80
    char = block.per_text(first_byte & ~SPACES[block.data])
    owner = words.owner

    at = words.windows(3)
    keys = mix(gram_hashes(hashes, at, 3) ^ mix(owner[at].astype(np.uint64)))
    in_repeats = words.cover(at[repeated(keys)], 3) if len(at) else np.zeros(words.n, bool)

    spans = longest_repeats(hashes, owner)
    long = np.flatnonzero(spans >= MIN_REPEAT)
    covered = words.cover(long, spans[long])
    longest = np.zeros(block.n, np.int64)
    np.maximum.at(longest, owner[long], spans[long])

    n_words = words.counts
    n_repeat = np.bincount(owner[in_repeats], minlength=block.n)
    n_covered = np.bincount(owner[covered], minlength=block.n)
    failed = (n_words < MIN_WORDS) | (100 * n_repeat > MAX_REPEAT_WORDS_PERCENT * n_words)
    method = (100 * n_covered <= MAX_COVERED_PERCENT * n_words) & (longest <= MAX_REPEAT)
    return {
        "n_words": n_words,
        "word_chars": char,
        "n_symbols": block.per_text(_SYMBOLS[block.data]),
        "n_dup_lines": duplicate_lines(block, words, sums),
        "n_repeat_words": n_repeat,
        "base_failed": failed,
        "kept": ~failed & method,
        "n_covered_words": n_covered,
    }


def duplicate_lines(block: TextBlock, words: Words, sums: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    if not words.n:
        return np.zeros(block.n, np.int64)
    breaks = np.flatnonzero(block.data == 10)
    starts = np.union1d(block.offsets[:-1], breaks + 1)
    starts = starts[starts < len(block.data)]
    ends = np.append(starts[1:], len(block.data))
    ends = ends - (block.data[ends - 1] == 10)
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    starts, ends = starts[worded], ends[worded]
    text = np.searchsorted(block.offsets, starts, "right") - 1
    keys = mix(span_hashes(sums, starts, ends) ^ mix(text.astype(np.uint64)))
    order = np.argsort(keys)
    held = keys[order]
    again = np.concatenate(([False], held[1:] == held[:-1]))
    return np.bincount(text[order[again]], minlength=block.n)


def _rules(texts: pa.Array) -> Columns:
    parts = [measure(block) for _, block in blocks(texts)]
    if not parts:
        return {name.split()[0]: [] for name in SCHEMA.split(", ")}
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]}


def quality_rules(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with the base counts, the base verdict and the verdict of the repetition rules."""
    return annotate(documents, text, [doc_id], _rules, SCHEMA)

"""Language identification with a small convolutional network over bytes, trained here in numpy.

A text is cut into windows of ``WINDOW`` bytes, the last one filled up with spaces. Each byte has an embedding; filters
of several widths run over a window, each filter's largest response counts, and a softmax layer over those gives
the window's language. A text's probabilities are the mean over all its windows, weighted by their bytes.

For prediction, embedding and filters are multiplied out once to one table row per byte value and filter position,
so a convolution is a sum of looked-up rows.

The network is fitted on the driver on at most about ``SAMPLE_PER_LANGUAGE`` labelled texts of each language, one
window of each. They are chosen by a hash of id and text, so the choice does not depend on partitions; the share of
each language is taken from its count over all rows. Prediction sees every byte of every text.

Cases: a null text or one without a letter is ``und`` with score 0. Without any labelled text every text is ``und``.
Rows without an id or label are predicted, but not learned from. Repeated rows are predicted alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hoopline.llm.blocks import TextBlock, blocks
from hoopline.llm.frames import Columns, annotate, slices

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBEDDING = 8
SAMPLE_PER_LANGUAGE = 1500
EPOCHS = 12
BATCH = 64
RATE = 0.01
SEED = 17
UNKNOWN = "und"
#: Texts whose best language has a lower mean probability are rejected by ``keep_identified``.
MIN_SCORE = 0.4
_AT_ONCE = 256


@dataclass
class Network:
    """Tables by filter position for each width, and the softmax layer."""

    languages: list[str]
    tables: list[np.ndarray]  # by width: (width, 256, FILTERS)
    bias: np.ndarray
    dense: np.ndarray
    offset: np.ndarray

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Probabilities for windows of bytes, shape (n, WINDOW)."""
        out = np.empty((len(x), len(self.languages)), np.float32)
        for at in range(0, len(x), _AT_ONCE):
            part = x[at : at + _AT_ONCE]
            pooled = np.concatenate([_responses(part, t).max(1) for t in self.tables], 1) + self.bias
            out[at : at + _AT_ONCE] = _softmax(np.maximum(pooled, 0) @ self.dense + self.offset)
        return out


def _responses(x: np.ndarray, table: np.ndarray) -> np.ndarray:
    span = x.shape[1] - len(table) + 1
    out = table[0][x[:, :span]]
    for j in range(1, len(table)):
        out += table[j][x[:, j : j + span]]
    return out


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def cut_windows(block: TextBlock) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, the text of each, its bytes); a text without bytes has none."""
    sizes = np.diff(block.offsets)
    counts = -(-sizes // WINDOW)
    first = np.concatenate(([0], np.cumsum(counts)))
    flat = np.full(first[-1] * WINDOW, 0x20, np.uint8)
    shift = np.repeat(first[:-1] * WINDOW - block.offsets[:-1], sizes)
    flat[np.arange(len(block.data)) + shift] = block.data
    owner = np.repeat(np.arange(block.n), counts)
    inside = np.arange(first[-1]) - first[owner]
    return flat.reshape(-1, WINDOW), owner, np.minimum(WINDOW, sizes[owner] - inside * WINDOW)


def train(texts: list[str], labels: list[str]) -> Network | None:
    """Fit the network with Adam; the same texts in the same order give the same network."""
    languages = sorted(set(labels))
    if not languages:
        return None
    x = np.full((len(texts), WINDOW), 0x20, np.uint8)
    for i, t in enumerate(texts):
        raw = t.encode()[:WINDOW]
        x[i, : len(raw)] = np.frombuffer(raw, np.uint8)
    y = np.searchsorted(languages, labels)
    rng = np.random.default_rng(SEED)
    total = FILTERS * len(WIDTHS)
    p = {
        "e": rng.normal(0, 0.5, (256, EMBEDDING)),
        "b": np.zeros(total),
        "d": rng.normal(0, 0.3, (total, len(languages))),
        "o": np.zeros(len(languages)),
    }
    p |= {f"w{w}": rng.normal(0, 1 / math.sqrt(w * EMBEDDING), (w, EMBEDDING, FILTERS)) for w in WIDTHS}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    mean, square = ({k: np.zeros_like(v) for k, v in p.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            for k, g in _gradients(p, x[rows], y[rows]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.001 * (g * g - square[k])
                p[k] -= RATE * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
    tables = [np.einsum("be,wef->wbf", p["e"], p[f"w{w}"]).astype(np.float32) for w in WIDTHS]
    return Network(languages, tables, p["b"], p["d"], p["o"])


def _gradients(p: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    n = len(x)
    best, pooled = [], []
    for w in WIDTHS:
        response = _responses(x, np.einsum("be,wef->wbf", p["e"], p[f"w{w}"]))
        at = response.argmax(1)
        best.append(at)
        pooled.append(np.take_along_axis(response, at[:, None, :], 1)[:, 0])
    z = np.concatenate(pooled, 1) + p["b"]
    h = np.maximum(z, 0)
    error = _softmax(h @ p["d"] + p["o"])
    error[np.arange(n), y] -= 1
    error /= n
    back = (error @ p["d"].T) * (z > 0)
    out = {"d": h.T @ error, "o": error.sum(0), "b": back.sum(0), "e": np.zeros_like(p["e"])}
    for k, w in enumerate(WIDTHS):
        g = back[:, k * FILTERS : (k + 1) * FILTERS]
        out[f"w{w}"] = np.empty_like(p[f"w{w}"])
        for j in range(w):
            seen = x[np.arange(n)[:, None], best[k] + j]  # the bytes that gave the largest responses
            out[f"w{w}"][j] = np.einsum("nfe,nf->ef", p["e"][seen], g)
            np.add.at(out["e"], seen.ravel(), (g[:, :, None] * p[f"w{w}"][j].T[None]).reshape(-1, EMBEDDING))
    return out


def held_out(doc_id: Column) -> Column:
    """The fold that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_languages(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> Network | None:
    """Fit on about ``per_language`` rows of each language outside the held-out fold."""
    rows = documents.select(
        documents[doc_id].cast("string").alias("id"), documents[text].alias("text"), documents[lang].alias("lang")
    ).filter(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("id")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30))
    limits = {k: int(min(1.0, per_language / n) * (1 << 30)) for k, n in counts.items()}
    chosen = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])[F.col("lang")]
    start = 1 + F.pmod(F.xxhash64("text", "id"), F.greatest(F.length("text") - WINDOW // 2, F.lit(1)))
    picked = rows.filter(draw < chosen).select(draw.alias("draw"), "lang", F.substring("text", start, F.lit(WINDOW)).alias("text"))
    sample = sorted((r["draw"], r["lang"], r["text"]) for r in picked.collect())
    return train([t for _, _, t in sample], [k for _, k, _ in sample])


def predict(network: Network | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(index of the best language, its mean probability); -1 and 0 for texts without bytes."""
    best, score = np.full(len(texts), -1), np.zeros(len(texts))
    if network is None:
        return best, score
    for row, block in blocks(texts):
        x, owner, size = cut_windows(block)
        total = np.zeros((block.n, len(network.languages)))
        np.add.at(total, owner, network.windows(x) * size[:, None])
        weight = np.bincount(owner, size, minlength=block.n)
        some = weight > 0
        mean = total[some] / weight[some, None]
        at = row + np.flatnonzero(some)
        best[at], score[at] = mean.argmax(1), mean.max(1)
    return best, np.clip(score, 0, 1)


def identify_languages(
    documents: DataFrame, network: Network | None, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: held_out, lang_pred and score."""

    def run(texts: pa.Array) -> Columns:
        best, score = predict(network, texts)
        return {"found": [network.languages[i] if i >= 0 else None for i in best], "mean": score}

    rows = documents.select(
        documents[doc_id].alias("doc_id"), documents[text].alias("text"),
        F.coalesce(documents[text].rlike(r"\p{L}"), F.lit(False)).alias("lettered"),
    )
    made = annotate(rows, "text", ["doc_id", "lettered"], run, "found string, mean double")
    known = F.col("lettered") & F.col("found").isNotNull()
    return made.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        F.when(known, F.col("found")).otherwise(F.lit(UNKNOWN)).alias("lang_pred"),
        F.when(known, F.col("mean")).otherwise(F.lit(0.0)).alias("score"),
    )


def keep_identified(
    documents: DataFrame, network: Network | None, text: str = "text", min_score: float = MIN_SCORE
) -> DataFrame:
    """The documents, all columns, whose text has a letter and a language that is found with ``min_score``."""
    at = documents.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            _, score = predict(network, batch.column(at))
            yield batch.filter(pa.array(score >= min_score))

    return documents.filter(documents[text].rlike(r"\p{L}")).mapInArrow(run, documents.schema)

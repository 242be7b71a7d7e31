"""SentencePiece encoding and decoding over distinct marked words.

The model writes each space as a marker and its pieces never hold a marker after another character, so no merge
crosses from a character to a following marker. A text is therefore cut before each run of markers; each distinct
marked word is segmented once, kept in a table with its ids and its decoded text, and the parts are joined back by
position. The vocabulary is checked for this when a worker loads the model; a model for which it does not hold, or
which rewrites texts or merges spaces, is refused.

The table lives in the worker and is emptied when it holds over ``TABLE_WORDS`` words, so memory is bounded; results do
not depend on when that happens. No shuffle is needed: a table of all words of a corpus grows with the corpus, and
sending each word's position to it and back would move far more than the texts.

A null or empty text has no ids and decodes to nothing. Rows are encoded one by one, so repeated rows, ids and
other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from hoopline.llm.frames import Columns, annotate

MARK = "▁"
TABLE_WORDS = 200_000
#: Texts are encoded together up to this length, one at least; their words enter the table in one call.
BATCH_CHARS = 250_000
#: Texts of a batch that are Python strings at a time.
SLICE_ROWS = 200

SCHEMA = "n_tokens long, ids_sha256 string, decoded_sha256 string"
PIECES_SCHEMA = "ids array<int>, decoded string"


class MarkedWords:
    """Segments marked words once and remembers their ids and decoded texts."""

    def __init__(self, model: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("pieces of this model cross into the next marked word")
        probe = "a  b \t\néＡ "
        if self.model.decode(self.model.encode(probe)) != probe or self.model.encode("b")[0] != self.model.encode(" b")[-1]:
            raise ValueError("this model rewrites texts before it segments them")
        #: A piece that stands for a text start, so that what follows is segmented as in the middle of a text.
        self.lead = self.model.encode("a")
        if len(self.lead) != 1:
            raise ValueError("this model has no single piece for a short word")
        self.mark = self.model.piece_to_id(MARK)
        self.decimal = [str(i) for i in range(len(pieces))]
        special = self.model.is_byte, self.model.is_unknown, self.model.is_control, self.model.is_unused
        self.pieces = ["\0" if any(f(i) for f in special) else p.replace(MARK, " ") for i, p in enumerate(pieces)]
        #: By marked word its ids as decimal text joined by commas, and what they decode to if that is another text.
        self.ids: dict[str, str] = {}
        self.altered: dict[str, str] = {}

    def segment(self, words: list[str]) -> None:
        """Enter words that are not in the table."""
        # the library puts a marker before a text, and a word's own first marker stands for it
        for word, ids in zip(words, self.model.encode([w[1:].replace(MARK, " ") for w in words], num_threads=1)):
            if word == MARK:
                ids = [self.mark]
            self.ids[word] = ",".join([self.decimal[i] for i in ids])
            plain = "".join([self.pieces[i] for i in ids])
            # bytes and unknown characters are put together by the library
            decoded = self.model.decode(self.lead + ids)[1:] if "\0" in plain else plain
            if decoded != word.replace(MARK, " "):
                self.altered[word] = decoded

    def encode(self, texts: list[str | None]) -> Iterator[tuple[str, int, str]]:
        """For each text its ids as decimal text joined by commas, their number, and the decoded text."""
        start = 0
        while start < len(texts):
            end, chars = start, 0
            while end < len(texts) and (end == start or chars < BATCH_CHARS):
                chars += len(texts[end] or "")
                end += 1
            yield from self._encode([marked_words(t) if t else [] for t in texts[start:end]])
            start = end

    def _encode(self, texts: list[list[str]]) -> Iterator[tuple[str, int, str]]:
        if len(self.ids) > TABLE_WORDS:
            self.ids.clear()
            self.altered.clear()
        self.segment(list(set().union(*texts) - self.ids.keys()))
        ids_of = self.ids.__getitem__
        for words in texts:
            ids = ",".join(map(ids_of, words))
            if self.altered and not self.altered.keys().isdisjoint(words):
                decoded = "".join([self.altered.get(w) or w.replace(MARK, " ") for w in words])
            else:
                decoded = "".join(words).replace(MARK, " ")
            yield ids, ids.count(",") + bool(words), decoded[1:]


def marked_words(text: str) -> list[str]:
    """The text with a marker for each space and one before it, cut before each run of markers."""
    text = text.replace(MARK, " ")
    words = (MARK + text.replace(" ", " " + MARK)).split(" ")
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return words
    out, run = [], ""
    for word in words:
        run += word
        if word != MARK:
            out.append(run)
            run = ""
    return out + [run] if run else out


@lru_cache(maxsize=1)
def _loaded(model: str) -> MarkedWords:
    return MarkedWords(model)


def id_columns(words: MarkedWords, texts: pa.Array) -> Columns:
    """Ids and decoded texts as Arrow arrays; a batch's ids are held as 4-byte numbers, not as Python's."""
    ids, decoded, ends = [np.zeros(0, np.int32)], [], [0]
    for at in range(0, len(texts), SLICE_ROWS):
        for made, n, plain in words.encode(texts.slice(at, SLICE_ROWS).to_pylist()):
            if n:
                ids.append(np.fromstring(made, np.int32, sep=","))
            ends.append(ends[-1] + n)
            decoded.append(plain)
    return {"ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids))), "decoded": decoded}


def encode_pieces(documents: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the ids, and the text decoded from them. ``model``: the model file on each worker."""
    return annotate(documents, text, [doc_id], lambda texts: id_columns(_loaded(model), texts), PIECES_SCHEMA)


def piece_digests(documents: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: how many ids, and digests of the ids and of the decoded text."""

    def run(texts: pa.Array) -> Columns:
        words, out = _loaded(model), {f.split()[0]: [] for f in SCHEMA.split(", ")}
        for ids, n, decoded in words.encode(texts.to_pylist()):
            out["n_tokens"].append(n)
            out["ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
        return out

    return annotate(documents, text, [doc_id], run, SCHEMA)

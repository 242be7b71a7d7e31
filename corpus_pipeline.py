"""Documents to training tokens: five stages, each over all that its predecessor kept.

Each stage takes (spark, docs, sf_dir). All but the last return the columns of ``documents``; ``run`` writes what a
stage returns as Parquet in the shared folder and reads it again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hoopline.llm.decontaminate import decontaminate
from hoopline.llm.frames import stage, table
from hoopline.llm.language_id import fit_languages, keep_identified
from hoopline.llm.line_dedup import drop_duplicate_lines
from hoopline.llm.ngram_join import drop_near_duplicates
from hoopline.llm.pieces import encode_pieces
from hoopline.llm.queries import piece_model


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has shortened."""
    kind = dict(docs.dtypes)["n_chars"]
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text").cast(kind), F.col("n_chars")))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go that have no letter, or no language that the network is sure enough of."""
    return keep_identified(docs, fit_languages(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of lines that are alike the first stays; a document that loses every line goes."""
    return _counted(drop_duplicate_lines(docs))


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each group of near duplicates stays, of those with the smallest id; rows without words all stay."""
    return drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans shared with test items are cut out; documents that are mostly such spans go."""
    return _counted(decontaminate(docs, table(spark, sf_dir, "benchmark")))


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the text that the ids decode to."""
    made = encode_pieces(docs, piece_model())
    return made.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.col("decoded").alias("text"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece),
]

#: SQL has neither the trained network nor the encoder; tests/llm compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

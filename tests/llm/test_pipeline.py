"""The pipeline against a brute-force version of its stages, on a small table."""

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hoopline.llm.language_id import fit_languages, predict
from hoopline.llm.pieces import MarkedWords
from hoopline.llm.queries import piece_model

from test_line_dedup import shingles
from test_ngram_join import brute as components
from test_row_operators import words_of


def lines_kept(rows):
    """Texts by id without lines that are alike to an earlier one; ids of which a line stays."""
    seen, out = [], {}
    links = {}

    def root(i):
        while links.get(i, i) != i:
            i = links[i]
        return i

    places = [(d, k, l) for d, t in sorted(rows) for k, l in enumerate(t.split("\n")) if l.strip(" \t\v\f\r")]
    for i, (_, _, line) in enumerate(places):
        mine = shingles(line)
        for j, other in enumerate(seen):
            common = len(mine & other)
            if 100 * common >= 80 * (len(mine) + len(other) - common):
                a, b = root(i), root(j)
                links[max(a, b)] = min(a, b)
        seen.append(mine)
    first = {(d, k) for i, (d, k, _) in enumerate(places) if root(i) == i}
    for d, t in rows:
        parts = t.split("\n")
        worded = [k for k, l in enumerate(parts) if l.strip(" \t\v\f\r")]
        if not worded or any((d, k) in first for k in worded):
            out[d] = "\n".join(l for k, l in enumerate(parts) if k not in worded or (d, k) in first)
    return out


def decontaminated(texts, items, window=10):
    grams = set()
    for t in items:
        w = words_of(t)
        n = min(window, len(w))
        grams |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()
    out = {}
    for d, text in texts.items():
        spans = [m.span() for m in re.finditer("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", text)]
        words, hit = words_of(text), set()
        for n in {len(g) for g in grams}:
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
        if 100 * len(hit) > 60 * len(words):
            continue
        kept, at = [], 0
        for i in sorted(hit):
            if i - 1 not in hit:
                kept.append(text[at : spans[i][0]])
            at = spans[i][1]
        out[d] = "".join([*kept, text[at:]])
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    source = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{source}/documents.parquet").withColumn("text", F.substring("text", 1, 900))
    more = [(90001, None, "en", "x", None), (90002, "", "en", "x", 0), (90003, "12 34 !!", None, "x", 8)]
    docs.unionByName(spark.createDataFrame(more, docs.schema)).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{source}/benchmark.parquet").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    network = fit_languages(docs)
    import pyarrow as pa

    known = {d: t for d, t in rows.items() if t and re.search(r"[^\W\d_]", t) and predict(network, pa.array([t]))[1][0] >= 0.4}
    kept = lines_kept(list(known.items()))
    kept = {d: kept[d] for d, _, c in components(list(kept.items())) if c == d}
    clean = decontaminated(kept, [r["text"] for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()])
    words = MarkedWords(piece_model()).model
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert 90001 not in got and 90002 not in got and 90003 not in got and len(got) > 100
    assert set(got) == set(clean)
    for d, text in clean.items():
        assert got[d]["text"] == text and list(got[d]["ids"]) == words.encode(text) and got[d]["n_tokens"] == len(got[d]["ids"])


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, docs, folder).schema.names == docs.columns
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard", "benchmark_decontamination", "sentencepiece"
    ]


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_counts_follow_the_texts(spark, folder):
    rng = random.Random(1)
    text = "\n".join(" ".join(rng.choice("abcdefgh") * 3 for _ in range(12)) for _ in range(3))
    docs = spark.createDataFrame([(1, text + "\n" + text, "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.line_dedup(spark, docs, folder).first()
    assert got["n_chars"] == len(got["text"]) == len(text)

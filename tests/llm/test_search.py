"""Ranked search against a plain-Python scorer, with many NRA rounds, ties, nulls and repeated rows."""

import math
import random
import re
from collections import Counter

import pytest

from hoopline.llm import search
from hoopline.llm.search import ranked_search

DOCS = "doc_id long, text string, lang string"
ITEMS = "item_id long, text string"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    rows = [(i, d, Counter(words(t)), len(words(t))) for i, (d, t, *_) in enumerate(docs)]
    big_n = sum(1 for r in rows if r[3])
    big_l = sum(r[3] for r in rows)
    df = Counter(t for r in rows for t in r[2])
    out = []
    for item_id, text in sorted(set(items), key=str):
        scores = []
        for rid, doc_id, tf, n in rows:
            if not n:
                continue
            m = 25 + (75 * n * big_n) // big_l
            s = sum(
                math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 8 * m))
                for t in words(text)
                if tf[t]
            )
            if s > 0:
                scores.append((-s, -(2**63) if doc_id is None else doc_id, rid, doc_id))
        for rank, (s, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            out.append((item_id, rank, doc_id, -s))
    return sorted(out, key=str)


def run(spark, docs, items):
    got = ranked_search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()
    return sorted((tuple(r) for r in got), key=str)


@pytest.fixture
def shallow(monkeypatch):
    monkeypatch.setattr(search, "FIRST_DEPTH", 1)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(30)] + ["Alpha", "BETA", "gamma", "δέλτα", "x1"]
    docs = [(i, " ".join(rnd.choice(vocab[: rnd.randint(3, len(vocab))]) for _ in range(rnd.randint(0, 40))), "en") for i in range(n)]
    return docs, vocab


def test_equals_brute_force_over_many_rounds(spark, shallow):
    docs, vocab = corpus(1, 120)
    docs += [(None, "alpha beta gamma", "en"), (5, docs[5][1], "en"), (500, None, None), (501, "", "en"), (502, "!!! ...", "en")]
    rnd = random.Random(2)
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 6)))) for i in range(15)]
    items += [(15, "alpha alpha alpha"), (16, "nothing-here zzz"), (17, None), (18, ""), (3, items[3][1])]
    assert run(spark, docs, items) == brute(docs, items)


def test_ties_break_by_doc_id(spark, shallow):
    docs = [(i, "same words here", "en") for i in (9, 3, 7, 1, 12, 4, 6, 8, 2, 11, 10, 5)] + [(99, "other text", "en")]
    got = run(spark, docs, [(1, "same words")])
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert got == brute(docs, [(1, "same words")])


def test_fewer_than_ten_and_empty_tables(spark, shallow):
    docs = [(1, "rare word", "en"), (2, "common", "en"), (3, "common", "en")]
    assert run(spark, docs, [(7, "rare")]) == brute(docs, [(7, "rare")])
    assert run(spark, [], [(7, "rare")]) == []
    assert run(spark, docs, []) == []


def test_clashing_columns_are_ignored(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "x")], "doc_id long, text string, rank int, score string")
    items = spark.createDataFrame([(1, "a", 3)], "item_id long, text string, doc_id int")
    assert [tuple(r) for r in ranked_search(docs, items).collect()] == brute([(1, "a b c")], [(1, "a")])


def test_shards_and_query_blocks_equal_brute_force(spark, shallow, monkeypatch):
    monkeypatch.setattr(search, "POSTINGS_PER_CELL", 100, raising=False)
    monkeypatch.setattr(search, "TERMS_PER_BLOCK", 10, raising=False)
    docs, vocab = corpus(3, 90)
    docs += [(None, "alpha beta gamma", "en"), (5, docs[5][1], "en"), (500, None, None), (501, "ÀÉ x1-X1_x1\x7fδέλτα", "en")]
    rnd = random.Random(4)
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 40)))) for i in range(20)] + [(90, "àé ÀÉ X1")]
    assert run(spark, docs, items) == brute(docs, items)


def test_rounds_start_no_spark_jobs(spark, shallow):
    docs, vocab = corpus(5, 200)
    spark.sparkContext.setJobGroup("search-jobs", "")
    try:
        assert run(spark, docs, [(1, " ".join(vocab))]) == brute(docs, [(1, " ".join(vocab))])
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("search-jobs")) < 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

import hashlib
import random

import numpy as np
import pytest

from hoopline.llm.suffix_dedup import multikey_order, suffix_dedup


def brute(rows, length):
    """(bytes, removed, spans, digest) by comparing every string of ``length`` bytes."""
    raws = [(t or "").encode() for _, t in rows]
    seen = {}
    for i, raw in enumerate(raws):
        for k in range(len(raw) - length + 1):
            seen.setdefault(raw[k : k + length], []).append((i, k))
    gone = [np.zeros(len(r), bool) for r in raws]
    for places in seen.values():
        if len(places) > 1:
            for i, k in places:
                gone[i][k : k + length] = True
    out = []
    for raw, g in zip(raws, gone):
        left = np.frombuffer(raw, np.uint8)[~g].tobytes()
        spans = sum(bool(x) and not (k and g[k - 1]) for k, x in enumerate(g))
        out.append((len(raw), int(g.sum()), spans, hashlib.sha256(left).hexdigest()))
    return out


def make(rng, length):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(length // 2, 3 * length))) for _ in range(4)]
    rows = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            p = rng.choice(passages)
            cut = rng.randint(0, len(p))
            parts += [p[:cut] if rng.random() < 0.5 else p, "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 20)))]
        rows.append((rng.randint(0, 40), "".join(parts)))
    rows += [(900, None), (901, ""), (None, passages[0]), (902, "x"), (903, "a" * 3 * length), (904, "ab" * 2 * length)]
    return rows + rows[:5]


def check(spark, rows, length):
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, key string").repartition(5)
    got = suffix_dedup(df, length=length).collect()
    expected = [(i, *x) for (i, _), x in zip(rows, brute(rows, length))]
    order = lambda x: tuple(str(v) for v in x)
    assert sorted((tuple(r) for r in got), key=order) == sorted(expected, key=order)


@pytest.mark.parametrize("seed,length", [(1, 24), (2, 40), (3, 200)])
def test_equals_brute_force(spark, seed, length):
    check(spark, make(random.Random(seed), length), length)


def test_hot_passage_and_many_copies(spark):
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(60)) + passage + str(i)) for i in range(120)]
    rows += [(500 + i, "copy " * 30) for i in range(80)]
    check(spark, rows, 100)


def test_no_rows(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup(df).collect() == []


def test_kept_text(spark):
    text = "x" * 10 + "0123456789abcdefghij"
    df = spark.createDataFrame([(1, "A" + text), (2, "B" + text)], "doc_id long, text string")
    got = {r["doc_id"]: r["kept_text"] for r in suffix_dedup(df, length=20, keep_text=True).collect()}
    assert got == {1: "A", 2: "B"}


def test_multikey_order():
    rng = random.Random(4)
    words = ["".join(rng.choice("a\0b") for _ in range(rng.randint(0, 30))).encode() for _ in range(500)]
    words += [b"abcdefgh" * 3, b"abcdefgh" * 3, b"abcdefgh" * 2, b""]
    data = np.frombuffer(b"".join(words) + b"z", np.uint8)
    sizes = np.array([len(w) for w in words])
    order, prefix = multikey_order(data, np.cumsum(sizes) - sizes, sizes)
    held = [words[i] for i in order]
    assert held == sorted(words)
    for a, b, p in zip(held, held[1:], prefix[1:]):
        common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert p == common

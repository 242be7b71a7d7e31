import random
import re

import pytest

from hoopline.llm.ngram_join import drop_near_duplicates, near_duplicates, prefix_size


def brute(rows, percent=80, size=5):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return sorted(out, key=str)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k] = f"w{rng.randint(0, 10**6)}"
    return " ".join(words)


def rows_of(seed):
    rng = random.Random(seed)
    rows, key = [], 0
    for group in range(12):
        base = [f"{rng.choice('abcdefgh')}{rng.randint(0, 40)}" for _ in range(rng.randint(6, 120))]
        for _ in range(rng.randint(1, 40) if group else 150):
            rows.append((key * 7 % 1009, edited(rng, base, rng.choice([0, 0, 1, 1, 2, 3, 4, 5]))))
            key += 1
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one two"), (None, "one")]
    rows += [(None, "lone text without an id of its own"), rows[3], (2006, rows[3][1].upper()), (2007, "x " * 4000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = rows_of(seed)
    df = spark.createDataFrame([(d, t, 1, "y") for d, t in rows], "doc_id long, text string, ref int, class string")
    got = near_duplicates(df.repartition(6)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_drop_keeps_one_of_each(spark):
    text = "a b c d e f g h i j k l m n"
    rows = [(3, text, "en"), (1, text, "en"), (2, "else", None), (None, "no id", "en"), (5, None, "en"), (6, "", "en")]
    got = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert got.columns == ["doc_id", "text", "lang"]
    assert sorted((r["doc_id"] for r in got.collect()), key=str) == [1, 2, 5, 6, None]


def test_drop_keeps_one_row_of_each_group(spark):
    a, b, x = ([f"{c}{k}" for k in range(60)] for c in "abx")
    a1, a2, b1, b2, x1, x2 = (" ".join(w + [e]) for w in (a, b, x) for e in ("one", "two"))
    rows = [
        (1, a1, "en"), (1, a1, "en"), (1, a1, "fr"), (2, a2, "en"), (None, a2, "en"),  # copies appended, one without an id
        (3, b2, "en"), (5, b1, "en"), (5, "not like the others", None),  # one id with two texts
        (None, x1, "en"), (None, x2, "en"), (None, x2, "en"), (None, "alone without an id", "en"),
        (7, "", None), (7, "", None), (None, None, None), (None, None, None),
    ]
    for n in (3, 5):
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(n)
        got = [tuple(r) for r in drop_near_duplicates(df).collect()]
        texts = sorted(str(r[:2]) for r in got if r[1] not in (x1, x2))
        assert texts == sorted(
            str(r) for r in [
                (1, a1), (3, b2), (5, "not like the others"), (None, "alone without an id"),
                (7, ""), (7, ""), (None, None), (None, None),
            ]
        )
        assert [r[0] for r in got if r[1] in (x1, x2)] == [None]


def test_no_rows(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_prefix_size():
    assert [prefix_size(n, 80) for n in (1, 5, 10)] == [1, 2, 3]

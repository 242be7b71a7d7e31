import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import zstandard

from hoopline.llm import bloom, line_dedup
from hoopline.llm.line_dedup import SHINGLE, band_hashes, deduplicated_lines, drop_duplicate_lines, line_shingles


def shingles(line):
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return {line[i : i + SHINGLE] for i in range(max(1, len(line) - SHINGLE + 1))}


def brute(rows):
    """Rows of (doc_id, n_lines, n_kept, digest): all pairs of lines, components, first line of each kept."""
    lines = sorted({l for _, t in rows for l in (t or "").split("\n") if l.strip(" \t\v\f\r")})
    sets, parent = [shingles(l) for l in lines], list(range(len(lines)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(lines)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    of = {l: root(i) for i, l in enumerate(lines)}
    first = {}
    for d, t in rows:
        for k, l in enumerate((t or "").split("\n")):
            if l in of:
                first[of[l]] = min(first.get(of[l], (True, 0, 10**9)), (d is None, d or 0, k))
    out = []
    for d, t in rows:
        kept, n, stay = [], 0, 0
        for k, l in enumerate((t or "").split("\n")):
            worded = l in of
            keep = not worded or first[of[l]] == (d is None, d or 0, k)
            n, stay = n + worded, stay + (worded and keep)
            kept += [l] if keep else []
        out.append((d, n, stay, hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(seed):
    rng = random.Random(seed)
    words = [f"{rng.choice('aeiouéß')}{rng.choice('bcdfg')}{rng.randint(0, 99)}x" for _ in range(300)]
    bases = [[rng.choice(words) for _ in range(rng.randint(1, 60))] for _ in range(40)]

    def line():
        base = list(rng.choice(bases))
        if rng.random() < 0.4:
            base[rng.randrange(len(base))] = rng.choice(words)
        return " ".join(base)

    rows = [(i * 13 % 211, "\n".join(rng.choice([line(), line(), "", "  "]) for _ in range(rng.randint(0, 8)))) for i in range(80)]
    return rows + [(500, None), (501, ""), (502, "\n\n"), (None, line()), (503, "Ab"), (504, "aB"), (505, "日本語のとても長い行です\n日本語のとても長い行です")]


def test_equals_brute_force(spark):
    rows = rows_of(3)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, place int").repartition(5)
    assert sorted((tuple(r) for r in deduplicated_lines(df).collect()), key=str) == brute(rows)


def test_repeated_rows_and_columns(spark):
    rows = [(1, "same line here", "x"), (1, "same line here", "x"), (2, "same line here\nother", None), (3, None, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = drop_duplicate_lines(df)
    assert got.columns == ["doc_id", "text", "name"]
    assert sorted(map(tuple, got.collect()), key=str) == [
        (1, "same line here", "x"), (1, "same line here", "x"), (2, "other", None), (3, None, "z")
    ]


def test_no_rows(spark):
    assert deduplicated_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_recall_of_bands_at_the_threshold():
    rng = np.random.default_rng(5)
    found = 0
    for trial in range(500):
        n = int(rng.integers(60, 400))
        common = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        extra = rng.integers(0, 1 << 63, (2, n // 8), dtype=np.uint64)  # similarity n / (n + n/4) = 0.8
        sets = [np.concatenate((common, e)) for e in extra]
        bands = band_hashes(np.repeat([0, 1], len(sets[0])), np.concatenate(sets), 2)
        found += (bands[0] == bands[1]).any()
    assert found >= 490


def test_shingles_are_characters():
    text = "Zäöü ßéèê x".encode()
    line, hashes = line_shingles(np.frombuffer(text, np.uint8), np.array([0]), np.array([len(text)]))
    assert len(hashes) == len("Zäöü ßéèê x") - SHINGLE + 1 and set(line) == {0}


def test_the_filter_of_wanted_lines_is_filled_in_place():
    values = np.random.default_rng(5).integers(-(2**63), 2**63 - 1, 5000)
    batch = pa.RecordBatch.from_arrays([pa.array(values)], ["ref"])
    tracemalloc.start()
    (made,) = bloom._set_bits(iter([batch, batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 * (1 << bloom.BITS) // 8
    bits = np.zeros((bloom.SLICES, (1 << bloom.BITS) // 8 // bloom.SLICES), np.uint8)
    for k, packed in zip(*(made.column(i).to_pylist() for i in (0, 1))):
        bits[k] = np.frombuffer(zstandard.decompress(packed), np.uint8)
    assert bloom.may_contain(bits.tobytes(), values).all()
    assert not bloom.may_contain(bits.tobytes(), np.arange(2000)).any()


def test_line_texts_are_read_once_for_all_rounds(spark, monkeypatch):
    """Lines that share bands but are not alike meet again in later rounds."""
    rnd, reads = random.Random(8), []
    base = [rnd.choice("abcdefghijklmnop") for _ in range(60)]
    lines = ["".join(rnd.choice("qrstuv") if rnd.random() < 0.03 else c for c in base) for _ in range(60)]
    rows = [(i, line) for i, line in enumerate(lines)]
    membership = line_dedup.membership
    monkeypatch.setattr(line_dedup, "membership", lambda wanted: reads.append(1) or membership(wanted))
    got = deduplicated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(rows))
    assert len(reads) == 1

"""Merkle manifest against a tree built in plain Python; sharding against its laws and a plain-Python map."""

import hashlib
import struct
import zlib

import pytest
import xxhash

from hoopline.llm.merkle import manifest
from hoopline.llm.sharding import SLOTS, assign_shards, rebalance, shard_loads, slot_loads, slot_maps

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    if v is None:
        return "-"
    s = v if isinstance(v, str) else str(v)
    return f"{len(s.encode())}:{s}"


def leaf(doc_id, text, lang, source, n_chars):
    return H(*(field(x) for x in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        cur = out[-1]
        out.append([H(*cur[i : i + 8]) for i in range(0, len(cur), 8)])
    return out


def sides(levels, pos):
    out = []
    for level in levels[:-1]:
        start = pos // 8 * 8
        run = level[start : start + 8]
        out.append(("".join(run[: pos - start]), "".join(run[pos - start + 1 :])))
        pos //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(*r), r))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda x: x[:3])
        trees[g] = levels_of([x[2] for x in groups[g]])
    top = levels_of([trees[g][-1][0] for g in order])
    out = []
    for gi, g in enumerate(order):
        for p, (_, _, lf, r) in enumerate(groups[g]):
            chain = sides(trees[g], p) + sides(top, gi)
            text = r[1]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and text is not None:
                text = text.translate(UPPER)
            acc = leaf(r[0], text, *r[2:])
            for a, b in chain:
                acc = H(a, acc, b)
            out.append((r[0], lf, trees[g][-1][0], top[-1][0], H(*[a + b for a, b in chain]), acc, acc == top[-1][0]))
    return sorted(out, key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def run(spark, rows, schema=SCHEMA):
    got = manifest(spark.createDataFrame(rows, schema)).collect()
    return sorted((tuple(r) for r in got), key=lambda x: (x[0] is None, x[0] or 0, x[1]))


def test_manifest_equals_plain_tree(spark):
    rows = [(i, f"Text {i} About Things" if i % 7 else None, ["en", "de", None, "fr"][i % 4], f"s{i % 3}", i) for i in range(150)]
    rows += [(3, "Text 3 About Things", "de", "s0", 3)] * 2  # repeated rows, a doc_id shared across languages
    rows += [(None, "No Id", "en", None, None), (1000, "", "é", "s", 0)]
    assert run(spark, rows) == brute(rows)


def test_manifest_sizes_at_level_edges(spark):
    for n in (1, 2, 8, 9, 64, 65):
        rows = [(i, f"Doc {i}", "en", "s", 1) for i in range(n)]
        got = run(spark, rows)
        assert got == brute(rows)
        if n == 1:
            assert got[0][1] == got[0][2] == got[0][3]  # a lone leaf is its subroot and the root


def test_manifest_tampering_caught(spark):
    rows = [(i, "Upper CASE text", "en", "s", 15) for i in range(40)]
    got = run(spark, rows)
    for r in got:
        assert r[6] == (zlib.crc32(str(r[0]).encode()) % 3 != 0)


def test_manifest_empty_and_clashing_columns(spark):
    assert manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    df = spark.createDataFrame([(1, "a", "en", "s", 1, "x", "y")], SCHEMA + ", leaf string, root string")
    assert [tuple(r) for r in manifest(df).collect()] == brute([(1, "a", "en", "s", 1)])


def spark_slot(v):
    h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=42)
    h = h - (1 << 64) if h >= 1 << 63 else h
    return h % SLOTS


def plain_maps(shards):
    m = [0] * SLOTS
    out = {1: list(m)}
    for n in range(2, shards + 1):
        seen = {}
        for slot in range(SLOTS):
            k = m[slot]
            seen[k] = seen.get(k, 0) + 1
            if seen[k] > SLOTS // n + (1 if k < SLOTS % n else 0):
                m[slot] = n - 1
        out[n] = list(m)
    return out


def test_shards_follow_the_key_law(spark):
    rows = [(i, "x" * (i % 50) if i % 9 else None, "en", "s", 1) for i in range(3000)] + [(5000 + i, "copy", "en", "s", 1) for i in range(3)]
    got = assign_shards(spark.createDataFrame(rows, SCHEMA), 24).collect()
    maps = plain_maps(25)
    assert len(got) == len(rows)
    for r in got:
        slot = spark_slot(r.doc_id)
        assert (r.slot, r.shard, r.grown_shard, r.law) == (slot, maps[24][slot], maps[25][slot], "key")
        assert r.grown_shard in (r.shard, 24)
    texts = {i: t for i, t, *_ in rows}
    for r in got[:200]:
        body = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(body) + 8, zlib.crc32(body))
    # the same key keeps its shard in another table
    other = assign_shards(spark.createDataFrame(rows[::7], SCHEMA), 24).collect()
    first = {r.doc_id: r.shard for r in got}
    assert all(first[r.doc_id] == r.shard for r in other)


def test_slot_map_versions_are_balanced_edits(spark):
    maps = slot_maps(spark, 6).collect()
    by = {}
    for r in maps:
        by.setdefault(r.version, {})[r.slot] = r.shard
    for n in range(1, 7):
        counts = [list(by[n].values()).count(k) for k in range(n)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == SLOTS
        if n > 1:
            assert all(by[n][s] in (by[n - 1][s], n - 1) for s in range(SLOTS))


def test_loads_and_rebalance(spark):
    rows = [(i, "y" * (i % 100), "en", "s", 1) for i in range(2000)]
    assigned = assign_shards(spark.createDataFrame(rows, SCHEMA), 4)
    loads = slot_loads(assigned)
    maps = slot_maps(spark, 4)
    per = {(r.version, r.shard): r.bytes for r in shard_loads(loads, maps).collect()}
    assert sum(v for (ver, _), v in per.items() if ver == 4) == sum(len(t) + 8 for _, t, *_ in rows)
    current = maps.where("version = 4").select("slot", "shard")
    edited = {r.slot: r.shard for r in rebalance(current, loads, 4, 3).collect()}
    before = {r.slot: r.shard for r in current.collect()}
    assert all(edited[s] in (before[s], 3) for s in before)


def test_shards_of_null_and_empty(spark):
    assert assign_shards(spark.createDataFrame([], SCHEMA), 24).collect() == []
    got = assign_shards(spark.createDataFrame([(None, None, None, None, None), (None, "", None, None, None)], SCHEMA), 24).collect()
    assert len({(r.slot, r.shard) for r in got}) == 1 and {r.size for r in got} == {8} and {r.text_crc32 for r in got} == {0}

"""JSON-array files read by byte ranges: the same records however the files are cut."""

import json
import random

import pyarrow as pa
from pyspark.sql import types as T

from hoopline.sources import json_arrays
from hoopline.sources.json_arrays import read_array_records, read_json_arrays, walk

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])


def records(n, seed=3):
    rnd = random.Random(seed)
    text = lambda: "".join(rnd.choice('ab}{][",\\\\ é') for _ in range(rnd.randint(0, 60)))
    return [{"id": i, "s": text(), "n": [1, {"x": "}"}] if i % 4 == 0 else {"y": [text()]}} for i in range(n)]


def test_walk_keeps_string_state():
    assert walk('{"a": "x}', False, 1, True) == (True, 2)
    assert walk('"}', True, 2, True) == (False, 0)  # the piece's own brace and the cutting one
    events = []
    walk('[{"a": [1]', False, 0, True, events)
    assert events == [(1, 1), (11, -1)]


def test_any_cut_gives_the_same_records(spark, tmp_path):
    recs = records(400)
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "flat.json").write_text(json.dumps(recs))
    (folder / "pretty.json").write_text(json.dumps(recs[:60], indent=2, ensure_ascii=False))
    (folder / "empty.json").write_text("[]")
    size = (folder / "flat.json").stat().st_size
    for ranges in (1, 7, 50):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(max(256, size // ranges)))
        got = {}
        for r in read_json_arrays(spark, str(folder)).collect():
            got.setdefault(r.file.rsplit("/", 1)[1], {})[r.ordinal] = json.loads(r.record)
        assert [got["flat.json"][i] for i in range(400)] == recs and len(got["flat.json"]) == 400
        assert [got["pretty.json"][i] for i in range(60)] == recs[:60] and "empty.json" not in got
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_records_that_do_not_fit_are_rejects(spark, tmp_path):
    folder = tmp_path / "bad"
    folder.mkdir()
    (folder / "a.json").write_text('[{"id": 1, "s": "ok}"}, {"id": "x"}, [1, 2], 7, {"id": 3}]')
    landed = read_array_records(spark, str(folder), SCHEMA)
    assert landed.counts == {"documents": 4, "rejected": 2, "parsed": 2}
    assert sorted((r.ordinal, r.id, r.s) for r in landed.rows.collect()) == [(0, 1, "ok}"), (3, 3, None)]
    assert sorted(r.reason for r in landed.rejects.collect()) == ["malformed", "malformed"]


def test_a_block_is_walked_without_being_held():
    record = '{"k": "' + "x" * 1000
    taken = 0

    def batches(n=100, rows=100):
        nonlocal taken
        for b in range(n):
            taken += 1
            pieces = [("," if b or i else "[") + record + '"' for i in range(rows)]
            if b == n - 1:
                pieces.append("]")
            size = n * rows * 2000
            yield pa.RecordBatch.from_pydict({
                "file": ["f"] * len(pieces), "block": [0] * len(pieces), "size": [size] * len(pieces), "length": [size] * len(pieces),
                "piece": pieces, "in_string": [False] * len(pieces), "depth": [0] * len(pieces)})

    made = json_arrays._parts(batches())
    rows = next(made).num_rows
    assert taken < 30  # the first records leave long before the block's end
    rows += sum(b.num_rows for b in made)
    assert (rows, taken) == (100 * 100, 100)
    (end,) = [b.to_pylist() for b in json_arrays._transitions(batches())]
    assert [(r["s_false"], r["d_false"]) for r in end] == [(False, 0)]

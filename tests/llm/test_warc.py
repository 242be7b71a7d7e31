import base64
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from hoopline.llm.warc import archive_round_trip, chunked, decode, read_archives, resolve_revisits, unchunked, write_archives


def expected(rows):
    top = {}
    for i, _, html in rows:
        key = html or ""
        top[key] = max([x for x in (top.get(key), i) if x is not None], default=None)
    out = []
    for i, _, html in rows:
        raw, best = (html or "").encode(), top[html or ""]
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        out.append((i, len(raw), digest, "response" if i == best else "revisit", None if i == best else best, None))
    return sorted(out, key=str)


def rows_of():
    rng = random.Random(1)
    rows = [(i, f"http://x/{i}", rng.choice(["é<p>", "WARC/1.1\r\n\r\n", "\0", "plain "]) * rng.choice([1, 50, 9000, 40000])) for i in range(40)]
    rows += [(100 + i, "http://y\r\nX: 1", "hot page") for i in range(30)]
    return rows + [(200, None, None), (201, "u", ""), (None, "u", "hot page"), (None, "n", "only null"), rows[0], rows[3], (202, "z", "x" * 500_000), (202, "z", "x" * 500_000)]


def test_round_trip(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, segment int").repartition(5)
    assert sorted((tuple(r) for r in archive_round_trip(df).collect()), key=str) == expected(rows)


def test_small_segments_and_revisit_size(spark, tmp_path):
    rows = [(1, "u", "abc" * 100), (2, "u", "abc" * 100), (3, "u", "x"), (4, "u", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    write_archives(df, f"{tmp_path}/w", min_revisit_bytes=2, segment_bytes=7)
    got = resolve_revisits(read_archives(spark, f"{tmp_path}/w")).collect()
    assert {r["page_id"]: (r["record_type"], r["payload_bytes"], r["problem"]) for r in got} == {
        "1": ("revisit", 300, None), "2": ("response", 300, None), "3": ("response", 1, None), "4": ("response", 1, None)
    }


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert archive_round_trip(df).count() == 0


def test_framing():
    body = b"0\r\n\r\n" * 9 + bytes(range(256))
    assert unchunked(chunked(body, 7)) == body and unchunked(chunked(b"")) == b""
    for broken in (b"5\r\nab\r\n0\r\n\r\n", b"2\r\nab\r\n", chunked(b"ab") + b"x"):
        with pytest.raises(ValueError):
            unchunked(broken)
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"
    assert decode(head + chunked(b"ab"), "WRONG") == (2, "digest differs")
    assert decode(head + b"zz", None) == (None, "broken chunk framing")


def test_lost_segment_is_reported(spark, tmp_path):
    from hoopline.llm import warc

    made = list(warc.page_records(1, "u", b"y" * 100, hashlib.sha1(b"y" * 100).hexdigest(), None, 60))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(made[:1] + made[2:]))
    got = read_archives(spark, str(tmp_path)).select("page_id", "problem", F.col("payload_bytes")).collect()
    assert [tuple(r) for r in got] == [("1", "a segment is missing", None)]

"""Texts that once stopped a job: they must end, in time linear in their length."""

import time

from hoopline.llm.html_extract import main_text
from hoopline.llm.surrogates import replace_personal_data


def test_html_without_closing_brackets_is_linear():
    for page in ("<a" * 500_000, "<!--" + "<a" * 500_000, "<p>" + "a<b" * 300_000 + "</p>", "<a " * 300_000 + ">"):
        started = time.time()
        main_text(page)
        assert time.time() - started < 5
    assert main_text("<p>kept</p><!-- open comment <p>gone</p>") == "kept"
    assert main_text("<p>one</p><p>two<a") == "one\n\ntwo<a"


def test_long_host_like_tokens_do_not_overflow(spark):
    rows = [(1, "x a@" + "a." * 6000), (2, "x a@" + "a." * 200_000 + "com"), (3, "write to bob@example.com")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r.text for r in replace_personal_data(df, "k").collect()}
    assert out[1] == rows[0][1] and out[2] == rows[1][1]  # no host of over 127 labels or a bare TLD-less tail
    assert "bob@example.com" not in out[3]

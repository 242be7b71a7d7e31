"""Operators that judge rows one by one: decontamination, pieces, language, extraction, quality rules."""

import collections
import hashlib
import random
import re
import tracemalloc
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from hoopline.llm import pieces
from hoopline.llm.blocks import blocks
from hoopline.llm.decontaminate import Items, SuffixAutomaton, contamination, decontaminate
from hoopline.llm.html_extract import extract_pages, main_text
from hoopline.llm.language_id import fit_languages, identify_languages, keep_identified
from hoopline.llm.pieces import MarkedWords, encode_pieces, piece_digests
from hoopline.llm.queries import piece_model
from hoopline.llm.repetition import MAX_REPEAT, longest_repeats, quality_rules

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words_of(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)


def contaminated(docs, items, window):
    out = []
    for d, text in docs:
        words, hit, named = words_of(text), set(), set()
        for name, t in items:
            item = words_of(t)
            n = min(window, len(item))
            grams = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
            for i in range(len(words) - n + 1):
                if tuple(words[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    named |= {str(name)} if name is not None else set()
        out.append((d, len(words), len(hit), len(named), sha(",".join(sorted(named))), bool(hit)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = ["aa", "Bb", "cc", "d4", "é", "FF"]
    text = lambda n: rng.choice([". ", " "]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, n)))
    items = [(i, text(9)) for i in range(12)] + [(3, text(6)), (20, None), (21, ""), (None, "d4 d4 d4"), (22, "aa " * 30)]
    docs = [(i, text(40)) for i in range(60)] + [(1, "aa"), (None, text(30)), (70, None), (71, ""), (72, "aa bb " * 5000)]
    ds = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, n_hit int")
    bs = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in contamination(ds, bs, window=4).collect()]
    assert sorted(got, key=str) == sorted(contaminated(docs, items, 4), key=str)


def test_spans_are_cut_and_mostly_copied_documents_go(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(1, f"Start here, {passage.upper()}; and quite some more words after it, enough to be worth keeping. é", "en"),
            (2, passage + " x", "en"), (3, "clean", None), (4, None, "en"), (5, "", "de")]
    ds = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["text"] for r in decontaminate(ds, spark.createDataFrame([(7, passage)], "item_id long, text string")).collect()}
    assert got == {1: "Start here, ; and quite some more words after it, enough to be worth keeping. é", 3: "clean", 4: None, 5: ""}
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(ds, none).count() == 5 and contamination(ds.limit(0), none).collect() == []


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr("hoopline.llm.decontaminate.BLOCK_CHARS", 12)
    items = [(i, f"w{i} x{i} y{i}") for i in range(6)]
    docs = [(i, f"a w{i} x{i} y{i} b w{i + 1} x{i + 1} y{i + 1}") for i in range(6)]
    got = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    assert sorted(map(tuple, got.collect())) == sorted(contaminated(docs, items, 10))


def test_automaton_knows_every_run():
    rng = random.Random(3)
    items = [[rng.randint(0, 2) for _ in range(rng.randint(0, 12))] for _ in range(8)]
    automaton = SuffixAutomaton()
    for x in items:
        automaton.add(x)
    runs = {tuple(x[i:j]) for x in items for i in range(len(x)) for j in range(i + 1, len(x) + 1)}
    for run in runs:
        state = 0
        for word in run:
            state = automaton.steps[state][word]
    assert Items([("1", None)]).shortest == 0 and len(automaton.steps) <= 2 * sum(map(len, items)) + 1


TRICKY = ["", " ", "  ", "a", " a ", "a  b", "▁", "a▁b ", "\x00a", "<s>x</s>", "\n\n x", "日本語 テキスト", "👍🏽", "ﬁ é", "a b", "<0x41>", "x" * 9000]


def test_pieces_equal_the_library(spark):
    library = MarkedWords(piece_model()).model
    rng = random.Random(1)
    texts = TRICKY + ["".join(rng.choice("ab  ▁\n\té日<>0xs/\x00👍") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    texts += [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet'").fetchall()]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, None, "y"), (0, "", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    expected = []
    for i, t, _ in rows:
        ids = library.encode(t or "")
        expected.append((i, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted((tuple(r) for r in piece_digests(df, piece_model()).collect()), key=str) == sorted(expected, key=str)
    for r in encode_pieces(df.filter("doc_id < 40"), piece_model()).collect():
        assert list(r["ids"]) == library.encode(texts[r["doc_id"]])
    assert piece_digests(df.limit(0), piece_model()).collect() == []


def test_table_of_words_stays_bounded(monkeypatch):
    monkeypatch.setattr("hoopline.llm.pieces.TABLE_WORDS", 10)
    monkeypatch.setattr("hoopline.llm.pieces.BATCH_CHARS", 50)
    words = MarkedWords(piece_model())
    texts = [f"word{i} other{i}" for i in range(100)]
    got = [x[0] for x in words.encode(texts)]
    assert got == [",".join(map(str, words.model.encode(t))) for t in texts] and len(words.ids) < 40


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    network = fit_languages(docs)
    extra = spark.createDataFrame([(None, None, "en"), (-1, "", "en"), (-2, "12 !! 34", "de"), (-3, "x", None)], "doc_id long, text string, lang string")
    rows = identify_languages(docs.select("doc_id", "text", "lang").unionByName(extra), network).collect()
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    held = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows if r["doc_id"] is not None)
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]] for r in held]) > 0.97 and len(held) > 200
    assert {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] in (None, -1, -2)} == dict.fromkeys((None, -1, -2), ("und", 0.0))
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = keep_identified(docs, network)
    assert kept.columns == docs.columns and kept.count() > 0.98 * len(truth)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r) for r in identify_languages(df, fit_languages(df)).collect()] == [(1, False, "und", 0.0)]
    assert identify_languages(df.limit(0), fit_languages(df.limit(0))).collect() == []
    assert keep_identified(df, None).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body class=menu>
<header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a><li><a href="/x">X</a></ul></nav><div id="cookie-notice"><p>We, you, and cookies, all agree.</p></div>
<div class="wrap"><article><h1>A &amp; B</h1><p>First, with <b>bold<br>and</b> a <a href=x>link</a>.<p>Second &lt;one&gt;  with
space.<ul><li>item one, kept<li>item two</ul><div class="ad-slot">Buy</div><ul><li><a href=1>Next</a><li><a href=2>Last</a></ul>
<form><p>Name, please, now</p></form><table><tr><td>c1<td>c2</table>tail text</article>
<section class="comments"><article><p>Great, really, long, comment, with, many, commas, indeed, yes, more, and more of them.</p></article></section></div>
<aside>side</aside><footer>&copy; x</footer>"""


def test_extraction(spark):
    expected = "A & B\n\nFirst, with bold and a link.\n\nSecond <one> with space.\n\nitem one, kept\n\nitem two\n\nc1\n\nc2\n\ntail text"
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", "plain &lt; text"), (1, "u", PAGE), (4, "u", "<script>x"), (5, "u", "<p>" * 3000 + "deep")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, n_chars int")
    got = sorted((tuple(r) for r in extract_pages(df).collect()), key=str)
    texts = [expected, "", "", "plain < text", expected, "", "deep"]
    assert got == sorted([(p, u, t, len(t)) for (p, u, _), t in zip(rows, texts)], key=str)
    assert extract_pages(df.limit(0)).collect() == []


def test_best_container_and_siblings():
    prose = "A sentence with enough words, and commas, to be a paragraph of an article."
    page = f"<body><div><div class=a><p>{prose}</p><p>{prose}</p></div><h2>Head</h2><div><p>{prose}</p></div><div><a href=x>{prose}</a></div></div><div>x</div>"
    assert main_text(page) == "\n\n".join([prose, prose, "Head", prose])
    assert main_text("<ul><li><a href=1>one</a></ul>") == "" or main_text("<ul><li><a href=1>one</a></ul>") == "one"


def test_names_that_say_what_a_part_is_about():
    prose = "A sentence with enough words, and commas, to be a paragraph of an article."
    parts = [
        ("<h2 id=related-work>", "</h2>", "Related work"), ("<h2 id=side-effects class=header>", "</h2>", "Side effects"),
        ("<h3 id=form-validation>", "</h3>", "Form validation"), ("<section id=search-algorithms><p>", "</section>", prose + " 1"),
        ("<div class=social-policy><p>", "</div>", prose + " 2"), ("<div id=related><p>", "</div>", prose + " 3"),
        ("<div><div class=promotion><p>", "</div></div>", prose + " 4"), ("<p class=notice>", "</p>", "Short."),
        ("<div id=search>", "</div>", "tail"), ("<p>See <span class=ad>", "</span>.", "the spot"),
    ]
    expected = "\n\n".join([prose, *(t for _, _, t in parts[:-1]), "See the spot."])
    inner = f"<p>{prose}</p>" + "".join(a + t + z for a, z, t in parts)
    others = "<div class=ad>Buy</div><div class='share-buttons'>Share</div><div class=related><ul><li><a href=x>More, and more</a></ul></div>"
    for tag in ("article", "main", "div id=content"):
        page = f"<body><div id=sidebar><p>{prose}</p></div><{tag}>{inner}{others}</{tag.split()[0]}><div class=site-footer><p>{prose}</p></div>"
        assert main_text(page) == expected, tag
    assert main_text(f"<body><div class='page sidebar-right'><div><p>{prose}</p></div></div>") == prose


def test_pages_without_article_and_main():
    prose = "A sentence with enough words, and commas, to be a paragraph of an article."
    p = [f"{prose} {k}." for k in range(9)]
    block = "<div class=block><div class=inner>{}</div></div>"
    many = block.format("".join(f"<p>{x}</p>" for x in p[:4]))
    few = block.format("".join(f"<p>{x}</p>" for x in p[4:6]))
    one = block.format(f"<p>{p[6]}</p>")
    menu = "<ul><li><a href=1>Home</a><li><a href=2>About us</a></ul>"
    assert main_text(f"<body>{menu}<div id=content>{many}{few}</div><div>x</div>") == "\n\n".join(p[:6])
    deep = f"<body>{menu}<div id=content><section>{many}{few}</section><section>{few}{one}</section></div>"
    assert main_text(deep) == "\n\n".join([*p[:6], *p[4:7]])
    beside = f"<div><p>Short prose of its own.</p></div><section>{p[7]}</section><ul><li>{p[8]}</ul><div>Between</div>"
    page = f"<body><div id=a>{menu}{beside}<div>{''.join(f'<p>{x}</p>' for x in p[:6] * 4)}</div></div>"
    assert main_text(page) == "\n\n".join(["Short prose of its own.", p[7], p[8], "Between", *p[:6] * 4])
    sources = "<h2>Sources</h2><ul><li><a href=1>RFC 2616</a><li><a href=2>A paper on menus</a></ul><ul><li><a href=1>1</a><li><a href=2>Next</a></ul>"
    text = "\n\n".join([*p[:3], "Sources", "RFC 2616", "A paper on menus"])
    for tag in ("article", "main", "div"):
        assert main_text(f"<body>{menu}<{tag}>{''.join(f'<p>{x}</p>' for x in p[:3])}{sources}</{tag}>") == text, tag


def rules_of(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)

    def covered(n):
        counts = collections.Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        at = [i for i in range(len(words) - n + 1) if counts[tuple(words[i : i + n])] > 1]
        return {k for i in at for k in range(i, i + n)}

    lines = [l for l in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", l)]
    repeat, long = covered(3), covered(8)
    failed = len(words) < 50 or 100 * len(repeat) > 50 * len(words)
    kept = not failed and 100 * len(long) <= 40 * len(words) and not covered(MAX_REPEAT + 1)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeat), failed, kept, len(long))


def test_quality_rules_equal_brute_force(spark):
    rng = random.Random(2)
    phrase = [f"p{i}" for i in range(200)]
    texts = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 300))) for _ in range(30)]
    texts += [" ".join([*phrase[: rng.randint(1, 200)], *(f"x{rng.random()}" for _ in range(400)), *phrase]) for _ in range(20)]
    texts += ["\n".join(rng.choice(["a b", " ", "é #|<", "", "c"]) for _ in range(60)) for _ in range(10)]
    texts += [None, "", " \n ", "same " * 3000, "same " * 3000, "x"]
    texts += [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet'").fetchall()]
    df = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")
    got = {r["doc_id"]: tuple(r)[1:] for r in quality_rules(df).collect()}
    assert got == {i: rules_of(t) for i, t in enumerate(texts)}
    assert quality_rules(df.limit(0)).collect() == []


def test_longest_repeats():
    rng = np.random.default_rng(1)
    for _ in range(100):
        texts = [rng.integers(0, 3, rng.integers(0, 30)).tolist() for _ in range(4)]
        expected = []
        for t in texts:
            for i in range(len(t)):
                best = 0
                for j in range(len(t)):
                    k = 0
                    while i != j and max(i, j) + k < len(t) and t[i + k] == t[j + k]:
                        k += 1
                    best = max(best, k)
                expected.append(best)
        words = np.array([w for t in texts for w in t], np.uint64)
        assert longest_repeats(words, np.repeat(np.arange(4), [len(t) for t in texts])).tolist() == expected


def test_blocks_keep_rows_apart():
    texts = pa.array(["ab", None, "", "cdé", "f"] * 50)
    held = [block.text(i) if block.valid[i] else None for _, block in blocks(texts.slice(3, 190), 7) for i in range(block.n)]
    assert held == texts.slice(3, 190).to_pylist()
    assert list(blocks(pa.array([], pa.string()))) == []


def test_ids_of_a_batch_are_held_as_arrays(monkeypatch):
    """2,000 texts with over 1.5 million ids, of which no list of Python numbers is made."""
    columns = {}
    monkeypatch.setattr(pieces, "annotate", lambda df, text, keep, run, schema: columns.setdefault("run", run))
    encode_pieces(None, piece_model())
    texts = pa.array([" ".join(f"{(i * 37 + k) % 900} q" for k in range(250)) for i in range(2000)] + [None, ""])
    pieces._loaded(piece_model())
    tracemalloc.start()
    made = columns["run"](texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    ids = pa.array(made["ids"], pa.list_(pa.int32())).to_pylist()
    library = MarkedWords(piece_model()).model
    assert ids[:20] + ids[-2:] == [library.encode(t) if t else [] for t in texts.to_pylist()[:20] + [None, ""]]
    assert sum(map(len, ids)) > 1_500_000 and peak < 60_000_000

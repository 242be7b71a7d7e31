"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hoopline.llm.decontaminate import contamination
from hoopline.llm.frames import table
from hoopline.llm.html_extract import extract_pages
from hoopline.llm.language_id import fit_languages, identify_languages
from hoopline.llm.line_dedup import deduplicated_lines
from hoopline.llm.merkle import manifest
from hoopline.llm.ngram_join import near_duplicates
from hoopline.llm.pieces import piece_digests
from hoopline.llm.repetition import quality_rules
from hoopline.llm.search import ranked_search
from hoopline.llm.sharding import assign_shards
from hoopline.llm.suffix_dedup import suffix_dedup
from hoopline.llm.surrogates import replace_personal_data
from hoopline.llm.warc import archive_round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def piece_model() -> str:
    """The model file, on the driver and every worker: $HOOPLINE_PIECE_MODEL, or that of the tokenizers' package."""
    if named := os.environ.get("HOOPLINE_PIECE_MODEL"):
        return named
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None) -> Callable:
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


_ITEM_WORDS = r"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return _ITEM_WORDS.format(lower=_LOWER.format(text=f"coalesce({text}, '')"))


@query("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated_lines(table(spark, sf_dir, "documents"))


@query(
    "op2_ngram_jaccard_join",
    f"""
    with recursive d as (
        select doc_id, row_number() over () as r,
            list_filter(string_split_regex({_LOWER.format(text="coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w
        from documents
    ),
    grams as (
        select distinct r, array_to_string(w[k : k + least(5, len(w)) - 1], ' ') as g
        from (select r, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as k from d where len(w) > 0)
    ),
    sizes as (select r, count(*) as n from grams group by r),
    pairs as (
        select a.r as a, b.r as b, count(*) as c from grams a join grams b on a.g = b.g and a.r <> b.r group by all
    ),
    links as (
        select a, b from pairs join sizes x on x.r = a join sizes y on y.r = b where 100 * c >= 80 * (x.n + y.n - c)
    ),
    reach(r, s) as (
        select r, r from d union select reach.r, links.b from reach join links on links.a = reach.s
    )
    select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
    from d left join sizes using (r)
    join (select reach.r, min(e.doc_id) as component_id from reach join d e on e.r = reach.s group by reach.r) using (r)
    """,
)
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(
    "op3_decontaminate",
    f"""
    with d as (select doc_id, row_number() over () as r, {_words("text")} as w from documents),
    i as (select distinct cast(item_id as varchar) as item_id, {_words("text")} as w from benchmark),
    wins as (
        select distinct item_id, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') as g, least(10, len(w)) as n
        from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k from i where len(w) > 0)
    ),
    sizes as (select distinct n from wins),
    grams as (
        select r, k, n, array_to_string(w[k : k + n - 1], ' ') as g
        from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k from d, sizes where len(w) >= n)
    ),
    hits as (select r, k, grams.n, item_id from grams join wins using (g, n)),
    n_hit as (select r, count(distinct p) as n_hit from (select r, unnest(range(k, k + n)) as p from hits) group by r),
    named as (
        select r, count(*) as n_items, string_agg(item_id, ',' order by item_id) as ids
        from (select distinct r, item_id from hits where item_id is not null) group by r
    )
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
        coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
        coalesce(n_hit, 0) > 0 as contaminated
    from d left join n_hit using (r) left join named using (r)
    """,
)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op4_sentencepiece")
def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(table(spark, sf_dir, "documents"), piece_model())


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return identify_languages(documents, fit_languages(documents))


@query("op6_html_extraction")
def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


@query(
    "op7_quality_rules",
    r"""
    with d as (
        select doc_id, row_number() over () as r, coalesce(text, '') as t,
            list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
        from documents
    ),
    grams as (
        select r, n, k, array_to_string(w[k : k + n - 1], ' ') as g
        from (select r, w, n, unnest(range(1, len(w) - n + 2)) as k
              from d, (select unnest([3, 8, 151]) as n) where len(w) >= n)
    ),
    again as (
        select r, n, k from (select r, n, k, count(*) over (partition by r, n, g) as c from grams) where c > 1
    ),
    spans as (
        select r, count(distinct p) filter (n = 3) as n_repeat, count(distinct p) filter (n = 8) as n_covered,
            coalesce(bool_or(n = 151), false) as too_long
        from (select r, n, unnest(range(k, k + n)) as p from again) group by r
    ),
    lines as (
        select r, sum(c - 1) as n_dup
        from (select r, l, count(*) as c from (select r, unnest(string_split(t, chr(10))) as l from d)
              where regexp_matches(l, '[^\x20\x09-\x0D]') group by r, l)
        group by r
    ),
    m as (
        select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
            length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
            coalesce(n_dup, 0)::bigint as n_dup_lines, coalesce(n_repeat, 0)::bigint as n_repeat_words,
            coalesce(n_covered, 0)::bigint as n_covered_words, coalesce(too_long, false) as too_long
        from d left join spans using (r) left join lines using (r)
    )
    select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
            and 100 * n_covered_words <= 40 * n_words and not too_long as kept,
        n_covered_words
    from m
    """,
)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, {5 * i + 1}, 5))::bigint >> {20 - 5 * j - 5}) & 31) + 1)::int, 1)"
    for i in range(8)
    for j in range(4)
)


@query(
    "op8_warc",
    f"""
    with p as (select page_id, coalesce(html, '') as t, sha1(coalesce(html, '')) as h from pages),
    q as (select *, max(page_id) over (partition by h) as top from p)
    select page_id, strlen(t)::bigint as payload_bytes, {_BASE32} as payload_digest,
        case when page_id = top then 'response' else 'revisit' end as record_type,
        case when page_id = top then null else top end as refers_to
    from q
    """,
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages read back from archives. A record that fails its checks keeps its row, with no size."""
    return archive_round_trip(table(spark, sf_dir, "pages")).drop("problem")


@query("op9_suffix_dedup")
def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


@query("op10_surrogates")
def op10_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is the session's ``spark.hoopline.surrogateKey``; set a secret one in production."""
    key = spark.conf.get("spark.hoopline.surrogateKey", "no secret key is set")
    return replace_personal_data(table(spark, sf_dir, "documents"), key)


_TERMS = r"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _terms(text: str) -> str:
    return _TERMS.format(lower=_LOWER.format(text=f"coalesce({text}, '')"))


@query(
    "op11_ranked_search",
    f"""
    with d as (select doc_id, row_number() over () as r, {_terms("text")} as t from documents),
    stats as (select count(*)::bigint as big_n, sum(len(t))::bigint as big_l from d where len(t) > 0),
    tf as (
        select r, doc_id, n, term, count(*)::bigint as tf
        from (select r, doc_id, len(t)::bigint as n, unnest(t) as term from d) group by all
    ),
    df as (select term, count(*)::bigint as df from tf group by term),
    q as (
        select item_id, text, unnest({_terms("text")}) as term from (select distinct item_id, text from benchmark)
    ),
    scores as (
        select q.item_id, q.text, tf.r, tf.doc_id,
            sum(floor(1000 * ln((2.0 * big_n + 2) / (2.0 * df + 1)))::bigint
                * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * tf.n * big_n) // big_l))))::bigint as score
        from q join tf using (term) join df using (term), stats
        group by all
    )
    select item_id::bigint as item_id, rank::int as rank, doc_id::bigint as doc_id, score
    from (
        select *, row_number() over (partition by item_id, text order by score desc, doc_id asc nulls first, r) as rank
        from scores where score > 0
    )
    where rank <= 10
    """,
)
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item is a query against all documents."""
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_merkle_manifest")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"))


#: Shards of the dataset.
SHARDS = 24


@query("op13_sharding")
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents"), SHARDS)

"""Ranked lexical search of all documents for every query, by NRA over impact-sorted postings.

Scoring (integers but for the weight): terms are the maximal runs of letters, digits and non-ASCII characters,
A-Z lower-cased. ``N`` counts documents with a term, ``L`` all their terms, ``n`` one document's terms, ``df`` the
documents with a term, ``tf`` its count in the document. A term weighs ``w = floor(1000 ln((2N+2)/(2df+1)))``; a
document's ``m = 25 + (75 n N) div L``; a posting's impact is ``w * ((10^9 tf) div (1000 tf + 8 m))``. A query's
score for a document sums the impacts of the query's terms, a term as often as the query repeats it.

Method (NRA, no random access), over document shards: documents are dealt to shards of about ``POSTINGS_PER_CELL``
postings, and each cell (a shard and a block of queries) finds the 10 best documents of its shard for each of its
queries. There each query term's postings are read in impact order (impact descending, then doc_id, then row), all
lists of a query to the same depth, which doubles each round. A document seen so far has a lower bound (the impacts
read) and an upper bound (plus, for each term not yet seen in it, the impact at the head of that term's unread
list); an unseen document is bounded by the sum of the heads. A query is settled when its 10 best lower bounds are
exact and nothing else can reach or tie ahead of the 10th - every other document's upper bound is below it (or equal
with a later doc_id), and the unseen bound is below it - or, with fewer than 10 positive documents, when nothing
unread is worth anything and every seen document is exact. Scores are exact: reading a whole list always settles.
The 10 best of all documents are among the 10 best of the shards.

Scale: a document's terms are counted where it is read, and stored once; weights (which need all documents) come from
a count per wanted term. Documents are dealt to cells, not postings, and queries beside them: a row per query term and
shard. A cell's memory is bounded by ``POSTINGS_PER_CELL`` and ``TERMS_PER_BLOCK`` (and by one document or query, if
longer), and more documents or queries make more cells. The last ranking gets 10 rows per query and shard, which
Spark's window group limit cuts to 10 per task before the shuffle. No pair of documents is formed.

Edge cases: null and empty texts have no terms and are never found; a query without terms, or whose terms are
nowhere, returns no rows; a null doc_id ranks as the smallest; repeated document rows are separate documents
with one doc_id (both may be listed); repeated (item_id, text) query rows count once, distinct texts with one
item_id are separate queries whose ranks both start at 1; columns other than item_id/doc_id and text are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoopline.llm.frames import discard, slices, stage

# Fixed values of the scoring contract.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: What lies between terms: splitting on it gives the same terms as matching TERM, three times faster.
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
TOP_K = 10
#: Postings per term read in the first round; each round doubles it.
FIRST_DEPTH = 32
#: Postings of the documents of one shard, about.
POSTINGS_PER_CELL = 500_000
#: Query terms of one block of queries, about.
TERMS_PER_BLOCK = 200_000
_SMALLEST = -(2**63)
#: For each byte of a text: A-Z in lower case, what lies between terms as a space.
_PLAIN = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))


def terms(text: Column) -> Column:
    lower = F.translate(F.coalesce(text.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lower, BETWEEN), "")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each document's text (last column) the number of terms, the distinct terms, and how often each occurs."""
    for batch in slices(batches):
        sizes, words, tfs, ends = [], [], [], [0]
        for text in batch.column(2).cast(pa.large_binary()).to_pylist():
            found = text.translate(_PLAIN).split() if text else []
            counts = Counter(found)
            sizes.append(len(found))
            words.extend(counts)
            tfs.extend(counts.values())
            ends.append(len(words))
        ends = pa.array(ends, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), batch.column(1), pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(words, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
            ],
            names=["rid", "doc_id", "n", "terms", "tfs"],
        )


def counted_documents(docs: DataFrame) -> DataFrame:
    """(rid, doc_id, n, terms, tfs) per document row: how many terms, the distinct ones and their counts."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text")
    )
    return rows.mapInArrow(_counted, "rid long, doc_id long, n long, terms array<string>, tfs array<long>")


def query_terms(items: DataFrame) -> DataFrame:
    """(qid, item_id, term, q): each distinct (item_id, text) row is a query, q the repeats of a term in it."""
    queries = stage(
        items.select(items["item_id"].alias("item_id"), items["text"].cast("string").alias("text"))
        .distinct()
        .withColumn("qid", F.monotonically_increasing_id()),
        "search-queries",
    )
    return (
        queries.select("qid", "item_id", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("qid", "item_id", "term")
        .agg(F.count(F.lit(1)).alias("q"))
    )


Postings = tuple[np.ndarray, np.ndarray]


def best_of_lists(lists: list[Postings], n_docs: int, k: int, depth: int) -> list[tuple[int, int]]:
    """(document, score) of the ``k`` best positive documents, by NRA.

    ``lists``: for each query term the documents that hold it (numbers below ``n_docs``) and what it is worth there,
    highest first. Of equal scores the lower document comes first.
    """
    lower, found = np.zeros(n_docs, np.int64), np.zeros(n_docs, bool)
    lo, hi = 0, depth
    while True:
        for at, worth in lists:
            lower[at[lo:hi]] += worth[lo:hi]
            found[at[lo:hi]] = True
        # a document's upper bound: the heads of all unread lists, but for those it was read in
        heads = [(at[:hi], worth[hi]) for at, worth in lists if len(at) > hi]
        unseen = sum(int(head) for _, head in heads)
        passed = np.zeros(n_docs, np.int64)
        for at, head in heads:
            passed[at] += head
        seen = np.flatnonzero(found)
        low = lower[seen]
        high = low + (unseen - passed[seen])
        near = np.arange(len(seen))
        if len(seen) > k:
            near = np.flatnonzero(low >= np.partition(low, len(low) - k)[len(low) - k])
        best = near[np.lexsort((seen[near], -low[near]))][:k]
        if len(best) == k and low[best[-1]] > 0:
            last = best[-1]
            ahead = (high > low[last]) | ((high == low[last]) & (seen < seen[last]))
            ahead[best] = False
            settled = (low[best] == high[best]).all() and not ahead.any() and unseen < low[last]
        else:
            settled = unseen == 0 and not ((high > 0) & (low != high)).any()
        if settled:
            return [(int(seen[i]), int(low[i])) for i in best if low[i] > 0]
        lo, hi = hi, hi * 2


def _array(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks)


def _best_of_cell(k: int, depth: int, big_n: int, big_l: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """(qid, rid, doc_id, score) of the ``k`` best of a shard's documents for each query of a block."""

    def run(docs: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"qid": [], "row": [], "score": []}
        if docs.num_rows and queries.num_rows:
            # documents are numbered in the order of equal scores
            order = np.lexsort((_array(docs, "rid").to_numpy(), _array(docs, "doc_id").fill_null(_SMALLEST).to_numpy()))
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            words = _array(queries, "term").dictionary_encode()
            wanted = words.indices.to_numpy()
            held = _array(docs, "terms")
            term = pc.index_in(held.flatten(), value_set=words.dictionary).fill_null(-1).to_numpy()
            owner = np.repeat(np.arange(len(order)), pc.list_value_length(held).to_numpy())
            some = term >= 0
            term, owner, tf = term[some], owner[some], _array(docs, "tfs").flatten().to_numpy()[some]
            weights = np.zeros(len(words.dictionary), np.int64)
            weights[wanted] = _array(queries, "w").to_numpy()
            m = 25 + (75 * _array(docs, "n").to_numpy() * big_n) // big_l
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[owner]))
            reading = np.lexsort((place[owner], -impact, term))
            at, impact = place[owner][reading], impact[reading]
            edges = np.searchsorted(term[reading], np.arange(len(weights) + 1))
            qids, repeats = _array(queries, "qid").to_numpy(), _array(queries, "q").to_numpy()
            by_query = np.argsort(qids, kind="stable")
            for mine in np.split(by_query, np.flatnonzero(np.diff(qids[by_query])) + 1):
                spans = [(slice(edges[t], edges[t + 1]), q) for t, q in zip(wanted[mine], repeats[mine])]
                lists = [(at[span], impact[span] * q) for span, q in spans]
                for document, score in best_of_lists(lists, len(order), k, depth):
                    out["qid"].append(int(qids[mine[0]]))
                    out["row"].append(int(order[document]))
                    out["score"].append(score)
        rows = pa.array(out["row"], pa.int64())
        return pa.table(
            {
                "qid": pa.array(out["qid"], pa.int64()), "rid": docs.column("rid").take(rows),
                "doc_id": docs.column("doc_id").take(rows), "score": pa.array(out["score"], pa.int64()),
            }
        )

    return run


def _dealt(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """Per query: item_id, rank (1..), doc_id, score of its ``k`` best documents with a positive score."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    qt = stage(query_terms(items), "search-query-terms")
    counted = stage(counted_documents(docs), "search-counted")
    sizes = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n"), F.sum(F.size("terms"))).first()
    big_n, big_l, total = (int(size or 0) for size in sizes)
    if total == 0:
        return empty
    # Terms found nowhere add nothing and leave here.
    held = counted.select(F.explode("terms").alias("term")).join(qt.select("term").distinct(), "term", "left_semi")
    df = held.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2.0 * big_n + 2)) / (F.lit(2.0) * F.col("df") + F.lit(1.0)))).cast("long")
    live = stage(qt.join(df.select("term", w.alias("w")), "term"), "search-live")
    shards = -(-total // POSTINGS_PER_CELL)
    blocks = max(1, -(-live.count() // TERMS_PER_BLOCK))
    each = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    texts = counted.select(each(blocks).alias("block"), _dealt("rid", shards).alias("shard"), *counted.columns)
    asked = live.select(_dealt("qid", blocks).alias("block"), each(shards).alias("shard"), "qid", "term", "q", "w")
    found = stage(
        texts.groupBy("block", "shard").cogroup(asked.groupBy("block", "shard")).applyInArrow(
            _best_of_cell(k, FIRST_DEPTH, big_n, big_l), "qid long, rid long, doc_id long, score long"
        ),
        "search-found",
    )
    discard(counted)
    order = F.col("score").desc(), F.coalesce("doc_id", F.lit(_SMALLEST)), F.col("rid")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("qid").orderBy(*order))).where(F.col("rank") <= k)
    names = qt.select("qid", "item_id").distinct()
    return ranked.join(names, "qid").select(
        F.col("item_id").cast("long").alias("item_id"), F.col("rank").cast("int").alias("rank"), "doc_id", "score"
    )

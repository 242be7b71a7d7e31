"""A Merkle manifest of a table: a leaf per row, a tree per language, a root over the languages, and proofs.

Method (slot pivot): nodes of one level are numbered in order; a parent gathers the children at positions
``8p .. 8p+7`` by conditional aggregates, one column per slot (``max(h) filter (pos % 8 = j)``), and its digest
is the hash of those columns concatenated. The same columns give each child its siblings: the columns left of
its own slot and those right of it. Proofs are these sibling lists, carried down from the root one level at a
time by joins on the parent's position; folding a (tampered) leaf back up with them is one ``aggregate`` over
the list.

Digests: ``H`` is lowercase hex SHA-256 of its inputs concatenated, digests as their hex text. A leaf is ``H``
of doc_id, source, lang, n_chars, text, each ``-`` if null, else its UTF-8 byte count, ``:``, its value (integers
in decimal). Per language, leaves ascend by doc_id (null first), equal doc_ids by leaf; every 8 consecutive nodes
(the last run fewer, even one) become their ``H`` while a level has several nodes; what remains, a lone leaf
itself, is the language's subroot. Subroots ordered by language (null first, UTF-8 bytewise) give the root the
same way. ``proof_sha256`` is ``H`` of the siblings, level by level up to the root, left to right.
``folded_root`` is the root recomputed from the tampered leaf (for doc_ids whose unsigned crc32 of the decimal
text is divisible by 3, A-Z of the text become a-z; null text and null doc_id stay) with the original
siblings; ``verified`` tells whether it equals the root.

Scale: positions come from a range-partitioned sort with per-block offsets, so a language with a third of all
rows spreads over many tasks; parents group by (language, position div 8), which spreads the same way. Each
level is an eighth of the one below and is stored as a table; only the leaf level is as large as the input.

Edge cases: null columns hash as ``-``; empty texts as ``0:``; very long texts only take longer to hash;
repeated rows are separate leaves (equal, next to each other); an empty table gives an empty result; columns
other than the five are ignored, so clashing names do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hoopline.llm.frames import stage
from hoopline.operators.windows import with_positions

FANOUT = 8
#: Rows of the input that one task numbers when positions are made.
ROWS_PER_TASK = 200_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return digest(*(field(c) for c in (doc_id, source, lang, n_chars, text)))


def tampered_text(doc_id: Column, text: Column) -> Column:
    hit = F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 0
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(hit, lowered).otherwise(text)


def _parents(level: DataFrame) -> DataFrame:
    """Parents of a level (grp, pos, n, h): (grp, pos, n, h, cs), cs the children's digests by slot."""
    slot = F.col("pos") % FANOUT
    return (
        level.groupBy("grp", "n", (F.col("pos") / FANOUT).cast("long").alias("pos"))
        .agg(*[F.max(F.when(slot == j, F.col("h"))).alias(f"c{j}") for j in range(FANOUT)])
        .select("grp", "pos", "n", F.array(*[f"c{j}" for j in range(FANOUT)]).alias("cs"))
        .withColumn("h", F.sha2(F.array_join("cs", ""), 256))
    )


def _tree(nodes: DataFrame, widest: int, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Levels above ``nodes`` (grp, pos, n, h; n nodes in grp) and the tops: (grp, level, h)."""
    levels, tops, width, k, level = [], [], 1, 0, nodes
    while True:
        tops.append(level.where(F.col("n") <= width).select("grp", F.lit(k).alias("level"), "h"))
        if widest <= width:
            break
        level = stage(_parents(level.where(F.col("n") > width)), f"{label}-{k + 1}")
        levels.append(level)
        width, k = width * FANOUT, k + 1
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return levels, out


_SIDE = "struct<l:string,r:string>"


def _with_side(child: DataFrame, parent: DataFrame) -> DataFrame:
    """``child`` with ``chain``: its own siblings (from the parent's slot columns), then the parent's chain."""
    up = parent.select("grp", F.col("pos").alias("__pp"), F.col("cs").alias("__cs"), F.col("chain").alias("__up"))
    j = (F.col("pos") % FANOUT).cast("int")
    left = F.array_join(F.slice("__cs", F.lit(1), j), "")
    right = F.array_join(F.slice("__cs", j + 2, F.lit(FANOUT)), "")
    return (
        child.withColumn("__pp", (F.col("pos") / FANOUT).cast("long"))
        .join(up, ["grp", "__pp"])
        .withColumn("chain", F.concat(F.array(F.struct(left.alias("l"), right.alias("r"))), F.col("__up")))
        .drop("__pp", "__cs", "__up")
    )


def _chains(base: DataFrame, levels: list[DataFrame], tops: DataFrame, above: DataFrame, label: str) -> DataFrame:
    """``base`` (level 0) with ``chain``: sibling lists bottom-up, ending with ``above``'s chain of the grp's top."""
    above = above.select("grp", F.col("chain").alias("__above"))
    carried = None
    for k in range(len(levels), -1, -1):
        nodes = base if k == 0 else levels[k - 1]
        top = tops.where(F.col("level") == k).select("grp")
        at_top = nodes.join(top, "grp").join(above, "grp").withColumnRenamed("__above", "chain")
        if carried is None:
            chained = at_top
        else:
            chained = _with_side(nodes.join(top, "grp", "left_anti"), carried).unionByName(at_top)
        carried = chained if k == 0 else stage(chained, f"{label}-chain-{k}")
    return carried


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified (see the module)."""
    spark = docs.sparkSession
    d = docs.select(*[docs[c].alias(c) for c in FIELDS])
    rows = d.select(
        "doc_id",
        "lang",
        leaf(*(F.col(c) for c in FIELDS)).alias("h"),
        leaf(*(F.col(c) for c in FIELDS[:4]), tampered_text(F.col("doc_id"), F.col("text"))).alias("tampered"),
    )
    langs = (
        d.groupBy("lang")
        .agg(F.count(F.lit(1)).alias("n"))
        # One row per language.
        .withColumn("grp", F.row_number().over(Window.orderBy(F.col("lang").asc_nulls_first())) - 1)
    )
    langs = stage(langs, "manifest-langs")
    stats = langs.agg(F.sum("n"), F.max("n"), F.count(F.lit(1))).first()
    total, widest, n_langs = stats[0] or 0, stats[1] or 0, stats[2]
    empty = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if total == 0:
        return spark.createDataFrame([], empty)
    keyed = rows.join(langs.select("lang", "grp", "n"), rows["lang"].eqNullSafe(langs["lang"])).drop(
        rows["lang"]
    ).drop("lang")
    leaves = with_positions(keyed, ["grp"], ["doc_id", "h"], total, ROWS_PER_TASK).withColumnRenamed("__rn", "pos")
    leaves = stage(leaves, "manifest-leaves")

    levels, tops = _tree(leaves, widest, "manifest-level")
    subroots = stage(tops.select("grp", "h"), "manifest-subroots")
    # The subroots (one per language) are the leaves of the root's tree, positioned by the language's order.
    top_leaves = subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("pos"), F.lit(n_langs).alias("n"), "h")
    root_levels, root_tops = _tree(top_leaves, n_langs, "manifest-root")
    root = root_tops.first()["h"]
    nothing = spark.range(1).select(F.lit(0).alias("grp"), F.expr(f"cast(array() as array<{_SIDE}>)").alias("chain"))
    above = _chains(top_leaves, root_levels, root_tops, nothing, "manifest-root").select(
        F.col("pos").alias("grp"), "chain"
    )
    chained = _chains(leaves, levels, tops, above, "manifest-level")
    sides = F.transform("chain", lambda x: F.concat(x["l"], x["r"]))
    folded = F.aggregate("chain", F.col("tampered"), lambda acc, x: F.sha2(F.concat(x["l"], acc, x["r"]), 256))
    return (
        chained.join(subroots.withColumnRenamed("h", "subroot"), "grp")
        .select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.col("h").alias("leaf"),
            "subroot",
            F.lit(root).alias("root"),
            F.sha2(F.array_join(sides, ""), 256).alias("proof_sha256"),
            folded.alias("folded_root"),
        )
        .withColumn("verified", F.col("folded_root") == F.col("root"))
    )

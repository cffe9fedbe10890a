"""Document fingerprints from closed syncmers over words.

The text's words are hashed; a k-mer (``K`` consecutive words) is an anchor if the smallest of its inner
substrings (``S`` consecutive words) is its first or its last one. Whether a k-mer is chosen depends on its own
words only, so the same passage yields the same anchors in any document, in the same order and distance.

Built-in functions only. Defined cases: a NULL text counts as empty; in a text of fewer than ``K`` words each
inner substring is an anchor; a text of white space only, or an empty one, has none; equal texts have equal
fingerprints; two fingerprints without anchors have likeness 1, one without and one with anchors 0; rows of one
key, repeated rows included, follow each other in the order of their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, text_of

K = 5
S = 2

# Runs of neighbours are found within blocks of about BLOCK_ROWS documents; the driver holds the blocks' borders, so
# there are at most MOST_BLOCKS of them. A key that fills blocks alone, and rows without a key, are cut once more.
BLOCK_ROWS = 2000
MOST_BLOCKS = 4096
CUTS = 64


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+", -1), "")


def inner_hashes(of: Column) -> Column:
    """A 32-bit hash for each run of ``S`` words; for a shorter text one hash of all of it."""
    n = F.size(of)
    runs = F.transform(F.sequence(F.lit(0), F.greatest(n - S, F.lit(0))),
                       lambda i: F.hash(*[F.get(of, i + j) for j in range(S)]))
    return F.when(n > 0, runs).otherwise(F.expr("CAST(array() AS array<int>)"))


def anchors(inner: Column) -> Column:
    """array<struct<at, hash>>: word position and hash of each closed syncmer, in order of the text."""
    width = K - S + 1
    last = F.size(inner) - width

    def chosen(i: Column) -> Column:
        run = F.slice(inner, i + 1, width)
        return F.array_min(run).isin(F.get(inner, i), F.get(inner, i + width - 1))

    def anchor(i: Column) -> Column:
        return F.struct(i.alias("at"), F.hash(F.slice(inner, i + 1, width)).alias("hash"))

    each = F.transform(inner, lambda h, i: F.struct(i.alias("at"), h.alias("hash")))
    none = F.expr("CAST(array() AS array<struct<at:int,hash:int>>)")
    return (F.when(F.size(inner) == 0, none).when(last < 0, each)
            .otherwise(F.transform(F.filter(F.sequence(F.lit(0), last), chosen), anchor)))


def with_anchors(df: DataFrame, text: str = "text", result: str = "anchors") -> DataFrame:
    """``df`` with ``result``, the anchors of a text column; each step is computed once."""
    w, inner = fresh(df, "words", "inner")
    out = df.withColumn(w, words(text_of(text))).withColumn(inner, inner_hashes(F.col(w)))
    return out.withColumn(result, anchors(F.col(inner))).drop(w, inner)


def hashes(anchor_list: Column) -> Column:
    return F.transform(anchor_list, lambda a: a["hash"])


def shown(anchor_list: Column) -> Column:
    """The fingerprint as text: the anchors' hashes in hexadecimal, in order."""
    return F.array_join(F.transform(anchor_list, lambda h: F.hex(h.cast("long").bitwiseAND(0xFFFFFFFF))), ".")


def likeness(a: Column, b: Column) -> Column:
    """Shared distinct anchors over the mean number of distinct anchors (Dice), from 0 to 1."""
    da, db = F.array_distinct(a), F.array_distinct(b)
    total = F.size(da) + F.size(db)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def in_blocks(docs: DataFrame, block_rows: int = BLOCK_ROWS, most: int = MOST_BLOCKS) -> DataFrame:
    """Rows (key, whole) with ``block`` and ``spread``: blocks ascend in (key, spread, whole), missing keys last.

    Borders are quantiles of the keys. Rows whose key is a border twice over, or missing, are cut by ``spread``,
    the hash of their text.
    """
    blocks = min(max(1, docs.count() // block_rows), most)
    shares = [i / blocks for i in range(1, blocks)]
    found = (docs.agg(F.percentile_approx("key", shares, 10 * blocks).alias("b")).first()["b"] if shares else []) or []
    borders = sorted(set(found))
    hot = [b for b in borders if found.count(b) > 1]
    place, alone = F.lit(0), F.col("key").isNull()
    if borders:
        place = F.size(F.filter(F.lit(borders), lambda b: b < F.col("key")))
    if hot:
        alone = alone | F.col("key").isin(hot)
    cut = F.floor((F.col("spread") / F.lit(2.0**63) + 1) / 2 * CUTS).cast("int")
    return docs.withColumn("spread", F.xxhash64("whole")).withColumn(
        "block", F.when(F.col("key").isNull(), len(borders) + 1).otherwise(place) * (CUTS + 2)
        + F.when(alone, cut + 1).otherwise(0))


def fingerprints_with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS
                           ) -> DataFrame:
    """(key, n_chars, edited, own, edited_own, next): the hashes of the anchors of each document, of its edited text
    and of the next document, by ascending key; documents without a key come last and the first follows the last.

    The edited text is the text with its last half replaced by the first code points of the next document. A
    document alone follows itself. Rows of equal keys are ordered by their text.
    """
    plain = docs.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("whole"))
    placed = in_blocks(plain, block_rows)
    order = "PARTITION BY block ORDER BY key NULLS LAST, spread, whole"
    inside = with_anchors(placed, "whole", "own").withColumn("own", hashes(F.col("own"))).selectExpr(
        "key", "whole", "own", "block", f"lead(whole) OVER ({order}) AS next_whole", f"lead(own) OVER ({order}) AS next_own")

    # The first document of each block follows the last one of the block before. One row per block.
    least = placed.groupBy("block").agg(F.min(F.struct(F.col("key").isNull().alias("none"), "key", "spread")).alias("f"))
    ring = F.broadcast(least.selectExpr(
        "block AS first_block", "f.key AS first_key", "f.spread AS first_spread",
        "coalesce(lag(block) OVER (ORDER BY block), max(block) OVER ()) AS block"))
    firsts = placed.drop("block").join(
        ring, F.col("key").eqNullSafe(F.col("first_key")) & (F.col("spread") == F.col("first_spread"))).groupBy(
        "block").agg(F.min("whole").alias("first_whole"))
    firsts = with_anchors(firsts, "first_whole", "first_own").withColumn("first_own", hashes(F.col("first_own")))

    last = F.col("next_whole").isNull()
    joined = inside.alias("d").join(firsts.alias("f"), (F.col("d.block") == F.col("f.block")) & last, "left").select(
        "key", "whole", "own", F.coalesce("next_whole", "first_whole").alias("next_whole"),
        F.coalesce("next_own", "first_own").alias("next"))
    n = F.char_length("whole")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("whole", n - half), F.left("next_whole", half))
    out = joined.select("key", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", "next")
    return with_anchors(out, "edited", "edited_own").withColumn("edited_own", hashes(F.col("edited_own")))

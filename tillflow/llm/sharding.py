"""Shards by jump consistent hashing: a key's shard needs no ring table, and adding a shard moves only the
share of keys that now belongs to it.

Built-in functions only. Defined cases: rows without a key use a hash of their text as key, and 0 if that is
missing too; a NULL text has size 8 and the checksum of an empty text; rows with equal keys, copies and
repeated rows included, share a shard and get slots of their own; an empty table gives no rows; input columns
named like a result are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import fresh, text_of, with_results

# The generator of the published jump hash, in halves of 32 bits.
FACTOR = 2862933555777941757
_HIGH, _LOW = FACTOR >> 32, FACTOR & 0xFFFFFFFF
_MASK = 0xFFFFFFFF

# Every shard is numbered in this many independent blocks of keys; a prime, so that ids in steps spread too.
BLOCKS = 1009
ROW_BYTES = 8


def _next(high: Column, low: Column) -> tuple[Column, Column]:
    """key * FACTOR + 1 modulo 2**64 on 32-bit halves; no product exceeds 63 bits."""
    low0, low1 = low.bitwiseAND(0xFFFF), F.shiftright(low, 16)
    high0, high1 = high.bitwiseAND(0xFFFF), F.shiftright(high, 16)
    middle = low1 * _LOW
    bottom = low0 * _LOW + middle.bitwiseAND(0xFFFF) * 65536 + 1
    carry = F.shiftright(bottom, 32) + F.shiftright(middle, 16)
    crossed = (low * _HIGH).bitwiseAND(_MASK) + high0 * _LOW + (high1 * _LOW).bitwiseAND(0xFFFF) * 65536
    return (carry + crossed).bitwiseAND(_MASK), bottom.bitwiseAND(_MASK)


def jump(key: Column, shards: int) -> Column:
    """struct<shard, grown>: the shard of a 64-bit key among ``shards`` and among ``shards + 1``."""
    start = F.struct(
        F.shiftrightunsigned(key, 32).alias("high"), key.bitwiseAND(_MASK).alias("low"),
        F.lit(0).cast("long").alias("next"), F.lit(0).cast("long").alias("shard"), F.lit(0).cast("long").alias("grown"))

    def step(state: Column, _: Column) -> Column:
        high, low = _next(state["high"], state["low"])
        here = state["next"]
        # (high >> 1) are the upper 31 bits of the key.
        there = F.floor((here + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(high, 1) + 1).cast("double")))
        return F.when(here > shards, state).otherwise(F.struct(
            high.alias("high"), low.alias("low"), there.alias("next"),
            F.when(here < shards, here).otherwise(state["shard"]).alias("shard"), here.alias("grown")))

    # Every jump goes at least one shard further, so shards + 1 steps always suffice.
    steps = F.sequence(F.lit(1), F.lit(shards + 1))
    return F.aggregate(steps, start, step, lambda s: F.struct(
        s["shard"].cast("int").alias("shard"), s["grown"].cast("int").alias("grown")))


def stable_key(df: DataFrame, key: str, text: str) -> Column:
    """64-bit key: an integral key is used as it is, any other is hashed."""
    column = F.col(f"`{key}`")
    integral = dict(df.dtypes)[key] in ("tinyint", "smallint", "int", "bigint")
    own = column.cast("long") if integral else F.when(column.isNotNull(), F.xxhash64(column))
    return F.coalesce(own, F.when(F.col(f"`{text}`").isNotNull(), F.xxhash64(F.col(f"`{text}`"))), F.lit(0).cast("long"))


def assign_shards(df: DataFrame, shards: int = 24, key: str = "doc_id", text: str = "text", blocks: int = BLOCKS
                  ) -> DataFrame:
    """``df`` with ``size``, ``text_crc32``, ``shard``, ``slot`` (0, 1, ... within the shard) and ``grown_shard``.

    Slots come without gathering a shard in one task: rows are numbered within (shard, block) and moved up by
    the rows of the shard's earlier blocks. Only that table of counts is ordered by block.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    row, whole, k, placed, block = fresh(df, "row", "whole", "key", "placed", "block")
    keyed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(row), text_of(text).alias(whole),
                      stable_key(df, key, text).alias(k))
    keyed = keyed.withColumns({placed: jump(F.col(k), shards), block: F.pmod(k, F.lit(blocks)).cast("int")})

    counts = keyed.groupBy(F.col(f"{placed}.shard").alias("shard"), F.col(block).alias("block")).agg(
        F.count("*").alias("n")).selectExpr(
        "shard", "block",
        "sum(n) OVER (PARTITION BY shard ORDER BY block ROWS UNBOUNDED PRECEDING) - n AS before")

    sized = keyed.select(
        row, k, F.col(f"{placed}.shard").alias("shard"), F.col(f"{placed}.grown").alias("grown"),
        F.col(block).alias("block"), (F.octet_length(whole) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(F.col(whole).cast("binary")).alias("crc"))
    numbered = sized.selectExpr(
        "*", f"row_number() OVER (PARTITION BY shard, block ORDER BY {k}, crc, size) - 1 AS place")
    out = numbered.join(counts, ["shard", "block"])
    ready = out.select(f"{row}.*", F.struct("size", "crc", "shard", "grown", F.expr("before + place").alias("slot")
                                            ).alias(placed))
    return with_results(
        ready, size=F.col(f"{placed}.size"), text_crc32=F.col(f"{placed}.crc"), shard=F.col(f"{placed}.shard"),
        slot=F.col(f"{placed}.slot").cast("long"), grown_shard=F.col(f"{placed}.grown")).drop(placed)

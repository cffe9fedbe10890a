"""Near-duplicates by an inverted join over the coordinates of MinHash signatures.

Every distinct shingle set is posted under its (coordinate, value) pairs. Of ``COORDINATES`` pairs two sets must
share ``MATCHES`` to be compared; ordered by how many sets hold a pair, rarest first, such sets share one of
their first ``COORDINATES - MATCHES + 1`` pairs, so only those are joined (prefix), and sets with too few pairs
that any other set holds are never posted (skip). Two sets of similarity 0.8 share fewer than ``MATCHES`` pairs
with probability 4e-6. What is left is confirmed on the full sets of 64-bit shingle hashes; before that, signatures are
compared by one byte a coordinate, which lets more pairs pass but loses none.

Links inside a large group are not enumerated. In each posting list all sets are compared with one of them, the
centre, which shares most with the others; this is repeated ``ROUNDS`` times with other centres in the lists whose sets are not of one component yet.
Of the lists that still hold several components, the short ones are compared pair by pair, which is at most
``SHORT_LIST`` pairs a posting. The sets of longer ones are joined by the same prefix rule once more, on their full sets: a set of n shingles is posted under the rarest n - 0.8 n + 1 of them, and those no other such set has come first.
Only sets of different components are compared there, where sizes and places in the order allow it, and the sets of a list's largest component not with each other.

Defined cases: NULL and empty texts, and texts of white space only, have an empty set and no links; a text of
fewer words than a shingle has one shingle, all its words; copies and repeated rows are one set and one
component; a component is named by the smallest id in it, missing ids last; exactly one row of a component is
kept, also where ids are missing or repeat; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillflow.llm.common import drop_written, fresh, text_of, trimmed, written
from tillflow.llm.components import components

SHINGLE = 5
SIMILARITY = 0.8
COORDINATES = 64
MATCHES = 36
ROUNDS = 2
SHORT_LIST = 32

# Ids and pairs of ids up to this many are broadcast (16 bytes each); more are joined by a shuffle.
BROADCAST_ROWS = 500_000
# Text bytes that one step inside a task turns into arrays.
CHUNK_BYTES = 4 << 20

_ODD = np.random.default_rng(20).integers(1, 2**63, (COORDINATES, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, ascending; words after lower-casing A-Z."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    out = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        out = (out ^ h[i:len(words) - width + 1 + i]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDINATES 32-bit minima per non-empty set."""
    flat, starts = np.concatenate(sets), np.cumsum([0, *[len(s) for s in sets[:-1]]])
    out = np.empty((len(sets), COORDINATES), np.int32)
    for i, (a, b) in enumerate(_ODD):
        mixed = flat * a
        mixed ^= mixed >> np.uint64(32)
        mixed *= b
        out[:, i] = np.minimum.reduceat((mixed >> np.uint64(32)).astype(np.uint32), starts).view(np.int32)
    return out


def chunks(texts: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[str]]]:
    """(place of the first, texts) of a column in runs of bounded length; only one run is held as Python strings."""
    run, length, at = [], 0, 0
    for text in texts:
        run.append(text.as_py() or "")
        length += len(run[-1])
        if length >= most:
            yield at, run
            run, length, at = [], 0, at + len(run)
    if run:
        yield at, run


def _described(size: int, text_column: str, names: list[str]):
    """A function of record batches: the batch with n, k1, k2 and the signature of each text's shingle set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, run in chunks(batch.column(batch.schema.get_field_index(text_column))):
                sets = [shingle_hashes(t, size) for t in run]
                full = [s for s in sets if len(s)]
                rows = iter(_signatures(full)) if full else iter(())
                digests = [(xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else None) for s in sets]
                halves = np.array([[d >> 64, d & 0xFFFFFFFFFFFFFFFF] if d is not None else [0, 0] for d in digests],
                                  np.uint64).reshape(-1, 2).view(np.int64)
                extra = [
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                    pa.array([next(rows) if len(s) else None for s in sets], pa.list_(pa.int32()))]
                part = batch.slice(at, len(run))
                yield pa.RecordBatch.from_arrays([*part.columns, *extra], [*part.schema.names, *names])

    return trimmed(describe)


def _sets(size: int):
    """A function of record batches (node, whole): node and its full shingle set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, run in chunks(batch.column(1)):
                sets = [shingle_hashes(t, size).view(np.int64) for t in run]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(run)), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    return trimmed(describe)


def _postings(sets: DataFrame) -> DataFrame:
    """(token, node, weight): each set under the tokens of its prefix, of those that several sets hold.

    ``weight`` says how much of its signature a set shares with how many others.
    """
    tokens = sets.select("node", F.posexplode("signature").alias("i", "v")).select(
        "node", (F.col("i").cast("long") * 2**32 + F.col("v")).alias("token"))
    # Grouped tables are written before they are joined, so that adaptive execution can split a hot key's rows.
    shared = written(tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "shared")
    prefix = COORDINATES - MATCHES + 1
    listed = tokens.join(shared, "token").groupBy("node").agg(
        F.sum("held").alias("weight"),
        F.array_sort(F.collect_list(F.struct("held", "token"))).alias("tokens"))
    # Tokens no other set holds come first in the order and take their places of the prefix.
    free = prefix - (COORDINATES - F.size("tokens"))
    posted = written(listed.where(free > 0).select(
        "node", "weight", F.explode(F.slice("tokens", F.lit(1), free)).alias("t")).select("t.token", "node", "weight"), "postings")
    drop_written(shared)
    return posted


def _matching(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least MATCHES coordinates."""
    a, b = (sets.select(F.col("node").alias(c), F.col("signature").alias(f"s{c}")) for c in "ab")
    same = F.size(F.filter(F.zip_with("sa", "sb", lambda x, y: x == y), lambda x: x))
    return pairs.join(a, "a").join(b, "b").where(same >= MATCHES).select("a", "b")


def _small(df: DataFrame) -> DataFrame:
    """A stored table of ids, to be broadcast if it has at most BROADCAST_ROWS rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _links(pairs: DataFrame, sets: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The candidate pairs (a, b) that signatures and full sets confirm."""
    stored = written(_matching(pairs.distinct(), sets), "pairs")
    pairs = _small(stored)
    a, b = (full.withColumnRenamed("node", c).join(pairs, c).select("a", "b", F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = a.join(b, ["a", "b"]).select("a", "b", (F.size("sa") + F.size("sb")).cast("long").alias("sizes"),
                                        F.size(F.array_intersect("sa", "sb")).cast("long").alias("both"))
    links = written(both.where(100 * F.col("both") >= percent * (F.col("sizes") - F.col("both"))).select("a", "b"), "links")
    drop_written(stored)
    return links


def _all_links(posted: DataFrame, sets: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links that connect all sets that chains of similar sets connect."""
    links, apart, done = None, posted.withColumn("root", F.col("node")), []
    for turn in range(ROUNDS):
        # The first centre is the set nearest to all others, as the original of edited copies is; later ones are any.
        by = F.struct((-F.col("weight") if turn == 0 else F.xxhash64("node", "token", F.lit(turn))).alias("by"), "node", "root")
        centres = written(apart.groupBy("token").agg(F.min(by).alias("c")).select(
            "token", F.col("c.node").alias("a"), F.col("c.root").alias("ra")), "centres")
        pairs = apart.join(centres, "token").where("ra <> root").select("a", F.col("node").alias("b"))
        found = _links(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), sets, full, percent)
        drop_written(centres, *done)
        links = found if links is None else links.unionAll(found)
        roots = written(components(links), "roots")
        labelled = written(posted.join(roots, "node", "left").select(
            "token", "node", "weight", F.coalesce("root", "node").alias("root")), "labelled")
        several = written(labelled.groupBy("token").agg(
            F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("length"))
            .where("least < most").select("token", "length"), "several")
        apart = written(labelled.join(several, "token"), "apart")
        drop_written(roots, labelled, several)
        done = [apart]
        if apart.isEmpty():
            return links
    short, long = apart.where(F.col("length") <= SHORT_LIST), apart.where(F.col("length") > SHORT_LIST)
    x = short.select("token", F.col("node").alias("a"), F.col("root").alias("ra"))
    y = short.select("token", F.col("node").alias("b"), F.col("root").alias("rb"))
    pairs = x.join(y, "token").where("a < b AND ra <> rb").select("a", "b")
    if not long.isEmpty():
        pairs = pairs.unionAll(_rest(long, full, percent))
    return links.unionAll(_links(pairs, sets, full, percent))


def _rest(apart: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a shingle of their prefixes."""
    nodes = written(apart.select("node", "root").distinct(), "apart-nodes")
    each = full.join(_small(nodes), "node").select("node", "root", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    shared = written(each.groupBy("token").agg(F.count("*").alias("held")).where("held > 1"), "shared-shingles")
    listed = each.join(shared, "token").groupBy("node").agg(
        F.max("n").alias("n"), F.max("root").alias("root"),
        F.array_sort(F.collect_list(F.struct("held", "token"))).alias("tokens"))
    # Shingles no other set holds come first in the order; ``at`` counts them too.
    alone = F.col("n") - F.size("tokens")
    free = F.col("n") - F.expr(f"(n * {percent} + 99) div 100").cast("int") + 1 - alone
    posted = written(listed.where(free > 0).select(
        "node", "root", "n", alone.alias("alone"), F.posexplode(F.slice("tokens", F.lit(1), free)).alias("i", "t")).select(
        "t.token", "node", "root", "n", F.expr("alone + i").alias("at")), "rest-postings")
    largest = written(posted.groupBy("token", "root").count().groupBy("token").agg(
        F.max(F.struct("count", "root")).alias("m"), F.count("*").alias("roots")).where("roots > 1").select(
        "token", F.col("m.root").alias("major")), "major")
    x = posted.join(largest, "token").where("root <> major").select(
        "token", *[F.col(c).alias(f"{c}_x") for c in ("node", "root", "n", "at")])
    y = posted.select("token", *[F.col(c).alias(f"{c}_y") for c in ("node", "root", "n", "at")])
    # Sets of these sizes must share ``least`` shingles, so the first shared one cannot stand later than this.
    least = f"(({percent} * (n_x + n_y) + {99 + percent}) div {100 + percent})"
    met = written(x, "minor").join(y, "token").where("root_x <> root_y").where(
        f"n_x * 100 >= n_y * {percent} AND n_y * 100 >= n_x * {percent} AND at_x <= n_x - {least} AND at_y <= n_y - {least}")
    return met.select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    similarity: float = SIMILARITY) -> DataFrame:
    """``df`` with ``n_shingles``, ``component_id`` (smallest id of the component) and ``kept`` (one row of each)."""
    percent = round(similarity * 100)
    whole, node, n, k1, k2, signature = names = fresh(df, "whole", "node", "n", "k1", "k2", "signature")
    columns = [F.col(f"`{c}`") for c in df.columns]
    # The text is stored once; as a string it is used as it is, NULL included.
    is_text = dict(df.dtypes)[text] == "string"
    whole = text if is_text else whole
    with_whole = df.select(*columns) if is_text else df.select(*columns, text_of(text).alias(whole))
    schema = T.StructType([*with_whole.schema.fields, T.StructField(n, T.LongType()), T.StructField(k1, T.LongType()),
                           T.StructField(k2, T.LongType()), T.StructField(signature, T.ArrayType(T.IntegerType()))])
    described = with_whole.mapInArrow(_described(shingle, whole, names[2:]), schema)
    # The ids are stored with the rows; later steps only read them.
    base = written(described.withColumn(node, F.monotonically_increasing_id()), "described")

    known = F.struct(F.col(f"`{id}`").isNull().alias("missing"), F.col(f"`{id}`").alias("id"), F.col(node).alias("node"))
    first = base.where(F.col(n) > 0).groupBy(F.col(k1).alias("k1"), F.col(k2).alias("k2")).agg(
        F.min(F.struct(known.alias("first"), F.col(n).alias("n"), F.col(signature).alias("signature"))).alias("m"))
    sets = written(first.select("k1", "k2", "m.first", F.col("m.first.node").alias("node"), "m.n", "m.signature"), "sets")
    texts = base.select(F.col(node).alias("node"), F.col(f"`{whole}`").alias("whole"))

    posted, roots, done = _postings(sets), None, []
    if not posted.isEmpty():
        # Full sets and short signatures of all texts that are compared with any other.
        compared = written(posted.select("node").distinct(), "compared")
        chosen = _small(compared)
        full = written(texts.join(chosen, "node", "left_semi").select("node", "whole").mapInArrow(
            _sets(shingle), "node long, shingles array<long>"), "shingles")
        short = F.transform("signature", lambda v: (v.bitwiseAND(255) - 128).cast("tinyint"))
        signatures = written(sets.join(chosen, "node", "left_semi").select("node", short.alias("signature")), "signatures")
        links = _all_links(posted, signatures, full, percent)
        roots = written(components(links), "roots")
        done = [compared, full, signatures]
    drop_written(posted, *done)

    own = F.col("node") if roots is None else F.coalesce("root", "node")
    rooted = (sets if roots is None else sets.join(roots, "node", "left")).select("k1", "k2", "first", own.alias("root"))
    named = written(rooted.groupBy("root").agg(F.min("first").alias("named")), "named")
    labels = written(rooted.join(named, "root").select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), "named"), "labels")
    drop_written(sets, named, roots)
    out = base.join(labels, (F.col(k1) == F.col("l1")) & (F.col(k2) == F.col("l2")) & (F.col(n) > 0), "left")
    own = F.struct(F.col(f"`{id}`").alias("id"), F.col(node).alias("node"))
    name = F.when(F.col("named").isNotNull(), F.struct("named.id", "named.node")).otherwise(own)
    results = ("n_shingles", "component_id", "kept")
    return out.select(
        *[c for c, s in zip(columns, df.columns, strict=True) if s not in results], F.col(n).alias("n_shingles"),
        name["id"].alias("component_id"), (name["node"] == F.col(node)).alias("kept"))

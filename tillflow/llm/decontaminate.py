"""Benchmark passages in documents: a prefix-filtered join of word windows.

A window is ``window`` consecutive words of a benchmark item, or the whole item if it is shorter. A window's
set are its shingles of three words (all its words if it has fewer). They are ordered by their frequency in
the documents; a window can only occur where its rarest shingle does, so that one is its prefix and all that
is joined. The shingle's place fixes where the window must start (positional bound), the text's end whether
it fits (length bound), and the words themselves decide.

Built-in functions only. Defined cases: NULL and empty texts have no words; an item without words has no
windows; items without id mark words but are not listed; repeated items and ids count once; repeated documents
each get their row; with no benchmark rows nothing is contaminated; input columns named like a result are
replaced, all others are kept.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import text_of, written

# Fixed value: what a word is, after A-Z became lower case.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SHINGLE = 3

# Up to so many benchmark shingles (long keys, some 16 bytes each in the hash table) are broadcast; more are joined
# by a shuffle. The windows' limit is lower as they carry words.
BROADCAST_SHINGLES = 2_000_000
BROADCAST_WINDOWS = 100_000
RESULTS = ("n_words", "n_hit", "n_items", "item_ids", "contaminated")


def words(text: Column) -> Column:
    """Words after lower-casing A-Z only. ``lower`` does that for ASCII texts, and faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase))
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def shingles(of: Column, size: int) -> Column:
    """A hash for the ``size`` words from each position on. Near the end there are fewer words; such hashes
    can only add candidates."""
    return F.transform(of, lambda w, i: F.xxhash64(w, *[F.get(of, i + j) for j in range(1, size)]))


def benchmark_windows(benchmark: DataFrame, window: int, item: str = "item_id", text: str = "text"
                      ) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words, size) and the items that hold them (window_id, item)."""
    items = benchmark.select(F.col(f"`{item}`").cast("string").alias("item"), words(text_of(text)).alias("w"))
    last = F.greatest(F.size("w") - window, F.lit(0))
    each = items.where(F.size("w") > 0).select(
        "item", F.explode(F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, window))).alias("words"))
    held = written(each.withColumn("window_id", F.sha2(F.array_join("words", " "), 256)), "windows")
    return (held.select("window_id", "words", F.size("words").alias("size")).distinct(),
            held.where("item IS NOT NULL").select("window_id", "item").distinct())


def _tokens(windows: DataFrame) -> DataFrame:
    """(window_id, offset, token, size, needed): every shingle of every window."""
    parts = []
    for n in range(1, SHINGLE + 1):
        mine = windows.where(F.col("size") == n if n < SHINGLE else F.col("size") >= n)
        count = F.col("size") - (n - 1)
        parts.append(mine.select("window_id", "size", count.alias("needed"), F.posexplode(
            F.slice(shingles(F.col("words"), n), F.lit(1), count)).alias("offset", "token")))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def _sightings(docs: DataFrame, tokens: DataFrame, sizes: list[int], small: bool, window: int
               ) -> tuple[DataFrame, DataFrame]:
    """Documents (row_id, row, n_words), and where benchmark shingles stand in them
    (row_id, place, token, from, near): ``near`` are the words from ``from`` on that a window there can span.

    A document's first entry is a marker that always joins, so that its row and word count leave in the same pass.
    """
    marker = 0
    listed = tokens.select("token").distinct()
    marks = listed.sparkSession.range(1).select(F.lit(marker).cast("long").alias("token"))
    wanted = listed.unionAll(marks).distinct()
    entries = F.flatten(F.array(*[F.transform(
        shingles(F.col("w"), n), lambda t, i: F.struct(i.alias("place"), t.alias("token"))) for n in sizes]))
    first = F.array(F.struct(F.lit(-1).alias("place"), F.lit(marker).cast("long").alias("token")))
    base = docs.select("row", F.monotonically_increasing_id().alias("row_id"), words(F.col("whole")).alias("w"))
    if not small:
        base = written(base, "words")
    start = F.greatest(F.col("place") - (window - 1), F.lit(0))
    near = F.slice("w", start + 1, F.col("place") - start + window)
    hit = F.col("place") >= 0
    columns = ["row_id", "place", "token", F.when(~hit, F.col("row")).alias("row"),
               F.when(~hit, F.size("w")).cast("long").alias("n_words"), F.when(hit, start).alias("from"),
               F.when(hit, near).alias("near")]
    spread = base.withColumn("entries", F.concat(first, entries)).withColumn("entry", F.explode("entries"))
    if small:
        # Words and row are only copied for the entries that join.
        seen = spread.select("row_id", "row", "w", "entry.place", "entry.token").join(F.broadcast(wanted), "token")
    else:
        seen = spread.select("row_id", "entry.place", "entry.token").join(wanted, "token").join(base, "row_id")
    seen = written(seen.select(*columns), "sightings")
    return seen.where("place < 0").select("row_id", "row", "n_words"), seen.where("place >= 0").drop("row", "n_words")


def _covered(spans: Column) -> Column:
    """How many positions sorted (start, end) spans cover."""
    zero = F.struct(F.lit(0).alias("upto"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, zero, lambda s, x: F.struct(
        F.greatest(s["upto"], x["end"]).alias("upto"),
        (s["n"] + F.greatest(x["end"] - F.greatest(s["upto"], x["start"]), F.lit(0))).alias("n")), lambda s: s["n"])


def mark_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", window: int = 10,
                       broadcast_shingles: int = BROADCAST_SHINGLES, broadcast_windows: int = BROADCAST_WINDOWS
                       ) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit`` (words inside an occurring window), ``n_items``, ``item_ids`` (sorted as
    strings) and ``contaminated``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of(text).alias("whole"))
    windows, items = benchmark_windows(benchmark, window)
    tokens = _tokens(windows)
    found = tokens.select(F.least("size", F.lit(SHINGLE)).alias("n")).distinct().orderBy("n").collect()
    sizes = [r.n for r in found] or [SHINGLE]
    small = tokens.count() <= broadcast_shingles
    base, seen = _sightings(packed, tokens, sizes, small, window)

    frequency = seen.groupBy("token").agg(F.count("*").alias("seen"))
    # A window with a shingle that no document has cannot occur.
    prefix = tokens.join(frequency, "token").groupBy("window_id").agg(
        F.min(F.struct("seen", "token", "offset")).alias("rarest"), F.count("*").alias("found"),
        F.max("needed").alias("needed")).where("found = needed").select("window_id", "rarest.token", "rarest.offset")
    anchored = prefix.join(windows, "window_id")
    if windows.count() <= broadcast_windows:
        anchored = F.broadcast(anchored)
    start = F.col("place") - F.col("offset")
    part = F.slice("near", start - F.col("from") + 1, F.col("size"))
    hits = seen.join(anchored, "token").where(start >= F.col("from")).where(part == F.col("words")).select(
        "row_id", "window_id", start.alias("start"), (start + F.col("size")).alias("end"))
    marked = hits.join(items, "window_id", "left").groupBy("row_id").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("item_ids")).select(
        "row_id", _covered(F.col("spans")).alias("n_hit"), "item_ids")
    out = base.join(marked, "row_id", "left").select("row", F.struct(
        "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("item_ids", F.expr("CAST(array() AS array<string>)")).alias("item_ids")).alias("mark"))
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in RESULTS]
    return out.select(
        *kept, "mark.n_words", "mark.n_hit", F.size("mark.item_ids").cast("long").alias("n_items"), "mark.item_ids",
        (F.col("mark.n_hit") > 0).alias("contaminated"))

"""Language-model scores by online logistic mixing of bit predictors over hashed contexts.

A text is a row of tokens, and a token a row of bits. The first bit says whether the word belongs to the *head*, the
training words that stand often; ``CODE_BITS`` bits of its hash follow, and the share of the word among the head words of
these bits. A rarer training word has its share among those, in which words never seen weigh as much as those seen once
(at least a half); never seen words are one event of the score. For bits per byte they are spelled as well, byte by byte, eight bits a byte,
and closed by a space. The end of a text is a word too.

1. Words of the training texts are counted over all of them (hashes of 64 bits). The head is sent to every task: the words
   from the smallest count on for which at most ``head`` words remain.
2. For every bit the tasks count zeros and ones under several contexts: none, the last word, the last two words; within
   spelled words the last byte, the last two. (context, bits so far) is hashed into tables whose size follows the number of training
   tokens up to ``slots``; the tables of all tasks are added up in rounds of bounded fan-in.
3. A bit's probability is the squashed sum of the predictors' log odds, each times a weight. A gate picks the set of
   weights by how often the two longest contexts were seen. After each bit the weights move along the error. Texts are cut into
   lanes of ``LANE`` symbols that start with the same weights and run side by side.
4. The first weights are the mean of those that the lanes of all training texts end with, each bit predicted there from
   the counts without itself. Spelled words start from equal weights.
5. Scoring adds the logarithms. Counts of words outside the head come from a join of their hashes with the word counts.

The probabilities of all rows of events add up to at most one, those with spelled words of all texts too.

Defined cases: NULL and empty texts are the end token alone; rows without id are held out; repeated rows are scored and
learned from as often as they stand there; with no training text everything is spelled with untrained predictors; an
empty table gives no rows; a text of any length is scored whole; columns other than id and text are not used.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillflow.llm.common import text_of, trimmed, written

CODE_BITS = 7
LANE = 256
RATE = np.float32(0.015)
ALPHA = np.float32(0.4)

# Bounds of what is sent to every task; parameters of ``score_texts``.
HEAD = 1 << 19
SLOTS = 21

# Text bytes that one task counts contexts for, that one step holds as arrays, and that are hashed at once; counting needs
# no lanes side by side, so its steps are one piece long.
TASK_BYTES = 64 << 20
CHUNK_BYTES = 4 << 20
PIECE_BYTES = 1 << 20
# Symbols whose events are counted at once.
COUNTED = 1 << 17
# Lanes that run side by side, tables added up at once, entries of a table per row.
SIDE_BY_SIDE = 8192
FAN_IN = 32
PIECE = 1 << 16

_MIX, _ODD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_END = np.uint64(0x5851F42D4C957F2D)
_ROOT = 0x2545F4914F6CDD1D
_BYTES = np.random.default_rng(12).integers(1, 2**63, 256, dtype=np.uint64)
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_WORD = ~np.isin(np.arange(256), [32, *range(9, 14)])
_CLOSE = 32


# --- texts to tokens -----------------------------------------------------------------------------


@dataclass
class Tokens:
    """Tokens of consecutive texts: hashes, places and lengths of the words in ``data`` (ends have length 0), tokens per text."""

    data: np.ndarray
    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray


@functools.lru_cache(maxsize=1)
def _piece_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(n)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(_ROOT, -1, 2**64)
    return tuple(np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (_ROOT, inverse))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _word_hashes(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of words: differences of one running polynomial, moved to a common power."""
    out, i = np.empty(len(starts), np.uint64), 0
    up, down = _piece_powers(PIECE_BYTES)
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE_BYTES, "right")))
        first, last = int(starts[i]), int(ends[j - 1])
        if last - first > PIECE_BYTES:  # one word longer than a piece
            up, down = _powers(last - first)
        running = np.zeros(last - first + 1, np.uint64)
        np.cumsum(_BYTES.take(low[first:last]) * up[:last - first], out=running[1:])
        s, e = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (running.take(e) - running.take(s)) * down.take(s)
        i = j
    return _mixed(out ^ ((ends - starts).astype(np.uint64) * _ODD))


def tokens_of(data: np.ndarray, bounds: np.ndarray) -> Tokens:
    """Tokens of the texts ``data[bounds[i]:bounds[i + 1]]``."""
    low, inside = _LOW.take(data), _WORD.take(data)
    begins, closes = np.ones(len(data), bool), np.ones(len(data), bool)
    begins[1:], closes[:-1] = ~inside[:-1], ~inside[1:]
    begins[bounds[:-1][bounds[:-1] < len(data)]] = True
    closes[bounds[1:][bounds[1:] > 0] - 1] = True
    starts, ends = np.flatnonzero(inside & begins), np.flatnonzero(inside & closes) + 1
    upto = np.searchsorted(starts, bounds)
    counts = np.diff(upto) + 1
    last = np.cumsum(counts) - 1
    words = np.ones(len(starts) + len(counts), bool)
    words[last] = False
    hashes = np.full(len(words), _END)
    hashes[words] = _word_hashes(low, starts, ends)
    at, lengths = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    at[words], lengths[words] = starts, ends - starts
    return Tokens(low, hashes, at, lengths, counts)


def _chunks(batch: pa.RecordBatch, column: int, most: int | None = None) -> Iterator[tuple[int, int, Tokens]]:
    """(first row, rows, tokens) of runs of rows of at most ``most`` bytes, or of one row."""
    texts, n = batch.column(column), batch.num_rows
    buffers = texts.buffers()
    bounds = np.frombuffer(buffers[1], np.int32)[texts.offset:texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.empty(0, np.uint8)
    at, most = 0, CHUNK_BYTES if most is None else most
    while at < n:
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + most, "right")) - 1)
        yield at, to - at, tokens_of(data[bounds[at]:bounds[to]], bounds[at:to + 1] - bounds[at])
        at = to


# --- the model -----------------------------------------------------------------------------------


@dataclass
class Layer:
    """One kind of symbols: bits a symbol, log2 of the slots of each predictor's table (the first is without context).

    Four bits of a symbol share a block of 16 slots, so a context is hashed once per block and not once per bit.
    """

    bits: int
    logs: list[int]
    tables: list[np.ndarray] = field(default_factory=list)
    weights: np.ndarray | None = None

    def bases(self, j: int, block: int, context: np.ndarray | None, values: np.ndarray) -> np.ndarray:
        """First slots of the ``block``-th four bits of the symbols."""
        before = (1 << (4 * block)) | (values >> (self.bits - 4 * block))
        if j == 0:
            return (before << 4).astype(np.int32)
        mixed = (context + before.astype(np.uint64) * _ODD) * _MIX
        return (((mixed ^ (mixed >> np.uint64(31))) * _ODD >> np.uint64(68 - self.logs[j])) << np.uint64(4)).astype(np.int32)

    def inner(self, bit: int, values: np.ndarray) -> np.ndarray:
        """The place of a bit within its block: the bits of the block before it, after a leading one."""
        k = bit % 4
        return ((1 << k) | ((values >> (self.bits - bit)) & ((1 << k) - 1))).astype(np.int32)

    def one(self, bit: int, values: np.ndarray) -> np.ndarray:
        return ((values >> (self.bits - 1 - bit)) & 1).astype(np.int32)


def layers(tokens: int, most: int) -> tuple[Layer, Layer]:
    """Words and spelled bytes; the tables grow with the training tokens up to ``2 ** most`` slots."""
    log = min(max(math.ceil(math.log2(max(tokens, 1))), 16), most)
    return Layer(CODE_BITS + 1, [CODE_BITS + 5, log, log]), Layer(8, [12, min(17, log), min(20, log)])


@dataclass
class Head:
    """Frequent training words, ascending by hash, with their counts."""

    hashes: np.ndarray
    counts: np.ndarray
    index: np.ndarray = field(init=False)
    shares: np.ndarray = field(init=False)

    def __post_init__(self):
        # Where the words of each leading 20 bits begin: a lookup tries the few words of one entry.
        self.index = np.searchsorted(self.hashes, np.arange(2**20 + 1, dtype=np.uint64) << np.uint64(44))
        self.index[-1] = len(self.hashes)
        code = _code(self.hashes)
        totals = np.bincount(code, self.counts, 2**CODE_BITS)
        self.shares = np.log10(self.counts / np.maximum(totals[code], 1))

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash in the head, or -1."""
        top = (hashes >> np.uint64(44)).astype(np.int64)
        at, end = self.index.take(top), self.index.take(top + 1)
        out, open_ = np.full(len(hashes), -1), np.flatnonzero(at < end)
        at = at[open_]
        while len(open_):
            hit = self.hashes.take(at) == hashes.take(open_)
            out[open_[hit]] = at[hit]
            rest = ~hit & (at + 1 < end[open_])
            open_, at = open_[rest], at[rest] + 1
        return out


def _code(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(2**CODE_BITS - 1)).astype(np.int64)


@dataclass
class Symbols:
    """Symbols of consecutive texts with how many of their bits count, their contexts, and symbols per text."""

    values: np.ndarray
    depths: np.ndarray
    contexts: list[np.ndarray | None]
    counts: np.ndarray


def _shifted(values: np.ndarray, by: int, first: np.ndarray, fill) -> np.ndarray:
    """The value ``by`` places earlier; ``fill`` where that is before the ``first`` place of its row."""
    out = np.full(len(values), fill, values.dtype)
    out[by:] = values[:-by] if by < len(values) + 1 else values[:0]
    out[np.arange(len(values)) - first < by] = fill
    return out


def word_symbols(tokens: Tokens, places: np.ndarray) -> Symbols:
    known = places >= 0
    first = np.repeat(np.cumsum(tokens.counts) - tokens.counts, tokens.counts)
    last = _shifted(tokens.hashes, 1, first, _END)
    two = last * _ODD + _shifted(tokens.hashes, 2, first, _END)
    return Symbols(np.where(known, _code(tokens.hashes), 2**CODE_BITS).astype(np.int32),
                   np.where(known, CODE_BITS + 1, 1).astype(np.int32), [None, last, two], tokens.counts)


def spelled_symbols(tokens: Tokens, places: np.ndarray) -> Symbols:
    """The words outside the head, byte by byte, each closed by a space and a text of its own."""
    spelled = places < 0
    sizes, starts = tokens.lengths[spelled] + 1, tokens.starts[spelled]
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    inside = np.arange(len(first)) - first
    at = np.repeat(starts, sizes) + inside
    closing = inside == np.repeat(sizes - 1, sizes)
    values = np.full(len(at), _CLOSE, np.int32)
    values[~closing] = tokens.data[at[~closing]]
    contexts, mixed = [None], np.zeros(len(at), np.uint64)
    for by in (1, 2):
        mixed = mixed * np.uint64(257) + _shifted(values, by, first, _CLOSE).astype(np.uint64) + np.uint64(1)
        contexts.append(mixed)
    return Symbols(values, np.full(len(at), 8, np.int32), contexts, sizes)


def _count_plain(layer: Layer, symbols: Symbols, table: np.ndarray) -> None:
    """The counts without context follow from how often each value stands there."""
    for depth in np.unique(symbols.depths):
        times = np.bincount(symbols.values[symbols.depths == depth])
        values = np.flatnonzero(times).astype(np.int32)
        for bit in range(int(depth)):
            entry = 2 * (layer.bases(0, bit // 4, None, values) + layer.inner(bit, values)) + layer.one(bit, values)
            table += np.bincount(entry, times[values], len(table)).astype(table.dtype)


def count_bits(layer: Layer, symbols: Symbols, tables: list[np.ndarray]) -> None:
    """Add the zeros and ones of the symbols to the tables: entry ``2 * slot + bit``.

    The events of few symbols are held at once, and added in place: what this takes does not follow the tables or the texts.
    """
    _count_plain(layer, symbols, tables[0])
    for at in range(0, len(symbols.values), COUNTED):
        part = slice(at, at + COUNTED)
        depths, values = symbols.depths[part], symbols.values[part]
        contexts = [c if c is None else c[part] for c in symbols.contexts]
        for bit in range(layer.bits):
            deep = depths > bit
            if not deep.all():
                depths, values = depths[deep], values[deep]
                contexts = [c if c is None else c[deep] for c in contexts]
                if bit % 4:
                    bases = [b[deep] for b in bases]
            if bit % 4 == 0:
                bases = [layer.bases(j, bit // 4, contexts[j], values) for j in range(1, len(tables))]
            event = 2 * layer.inner(bit, values) + layer.one(bit, values)
            for base, table in zip(bases, tables[1:], strict=True):
                np.add.at(table, 2 * base + event, table.dtype.type(1))  # a number of the table's type is added fastest


_LOGS = np.log(np.arange(1 << 16, dtype=np.float32) + ALPHA)
_SEEN = np.digitize(np.arange(1 << 17), [1, 3, 16]).astype(np.int8)
GATES = 32
# Every layer has three predictors, and a constant as a fourth input.
INPUTS, BIAS = 4, np.float32(0.3)


class Mixer:
    """Runs lanes of symbols through a layer's predictors."""

    def __init__(self, layer: Layer, leave_out: bool = False):
        self.layer, self.leave_out = layer, leave_out
        # Zeros and ones of a slot as one number of 32 bits.
        self.tables = [t.reshape(-1, 2).astype(np.uint16, copy=False).view(np.uint32)[:, 0] for t in layer.tables]
        self.start = layer.weights if layer.weights is not None else np.full((GATES, INPUTS), 0.4, np.float32)
        self.sums, self.uses = np.zeros((GATES, INPUTS)), np.zeros(GATES)

    def run(self, symbols: Symbols) -> np.ndarray:
        """log10 of the probability of each text's symbols."""
        lanes = -(-symbols.counts // LANE)
        text = np.repeat(np.arange(len(lanes)), lanes)
        number = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = (np.cumsum(symbols.counts) - symbols.counts)[text] + number * LANE
        length = np.minimum(symbols.counts[text] - number * LANE, LANE)
        out = np.zeros(len(lanes))
        if not len(text):
            return out
        bases = [[self.layer.bases(j, block, symbols.contexts[j], symbols.values) for j in range(INPUTS - 1)]
                 for block in range(self.layer.bits // 4)]
        for at in range(0, len(text), SIDE_BY_SIDE):
            order = at + np.argsort(-length[at:at + SIDE_BY_SIDE], kind="stable")
            np.add.at(out, text[order], self._lanes(symbols, bases, start[order], length[order]))
        return out / math.log(10)

    def _lanes(self, symbols: Symbols, bases: list[list[np.ndarray]], start: np.ndarray, length: np.ndarray) -> np.ndarray:
        layer, n = self.layer, len(start)
        weights, uses = np.repeat(self.start[None], n, axis=0).reshape(-1, INPUTS), np.zeros(n * GATES, np.float32)
        rows = weights.view(np.complex128)[:, 0]  # the four weights of a set as one element, which moves faster
        logs, every = np.zeros(n), np.arange(n)
        for step in range(int(length[0])):
            active = int(np.searchsorted(-length, -step, "left"))
            at = start[:active] + step
            depths = symbols.depths.take(at)
            here, values = every[:active], symbols.values.take(at)
            kept = np.ones(active)  # probability of the symbol's bits
            for bit in range(layer.bits):
                if bit == 1:  # what is cut short after the first bit drops out; all others have all bits
                    whole = np.flatnonzero(depths > 1)
                    logs[:active] += np.log(kept)
                    if not len(whole):
                        break
                    here, at, values, first = whole, at.take(whole), values.take(whole), [b.take(whole) for b in first]
                    kept = np.ones(len(whole))
                if bit % 4 == 0:
                    first = [b.take(at) for b in bases[bit // 4]]
                one, inner = layer.one(bit, values), layer.inner(bit, values)
                if self.leave_out:
                    own_one = one.astype(np.uint32)
                    own_zero = 1 - own_one
                one = one.astype(np.float32)
                inputs, place = [], here * GATES + (16 if bit == 0 else 0)
                for j, table in enumerate(self.tables):
                    both = table.take(first[j] + inner)
                    zeros, ones = both & 0xFFFF, both >> 16
                    if self.leave_out:
                        zeros, ones = zeros - np.minimum(zeros, own_zero), ones - np.minimum(ones, own_one)
                    inputs.append(_LOGS.take(ones) - _LOGS.take(zeros))
                    if j >= INPUTS - 3:
                        place += _SEEN.take(zeros + ones) << (2 * (j - INPUTS + 3))
                inputs.append(BIAS)
                own = weights.take(place, axis=0)
                total = own[:, 0] * inputs[0]
                for j in range(1, INPUTS):
                    total += own[:, j] * inputs[j]
                error = one - 1 / (1 + np.exp(-np.minimum(np.maximum(total, -12), 12)))
                kept *= 1 - np.abs(error)
                move = error * RATE
                for j, x in enumerate(inputs):
                    own[:, j] += move * x
                rows[place] = own.view(np.complex128)[:, 0]
                if self.leave_out:
                    uses[place] = uses.take(place) + 1
            else:
                logs[here] += np.log(kept)
        if self.leave_out:
            uses = uses.reshape(n, GATES)
            self.sums += np.einsum("lgi,lg->gi", weights.reshape(n, GATES, INPUTS), uses)
            self.uses += uses.sum(axis=0)
        return logs


# --- jobs ----------------------------------------------------------------------------------------


def training_fold(id: str) -> Column:
    """True for the rows that are learned from."""
    return F.coalesce(F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % 5 != 1, F.lit(False))


def _counted_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> tuple[np.ndarray, np.ndarray]:
        hashes, where = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
        return hashes, np.bincount(where, np.concatenate([c for _, c in held])).astype(np.int64)

    def rows(words: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(words[0].view(np.int64)), pa.array(words[1])], ["h", "c"])

    for batch in batches:
        for _, _, tokens in _chunks(batch, 0):
            held.append(np.unique(tokens.hashes, return_counts=True))
        if sum(len(h) for h, _ in held) > 2_000_000:
            held = [merged()]
            if len(held[0][0]) > 1_000_000:
                yield rows(held.pop())
    if held:
        yield rows(merged())


def word_counts(texts: DataFrame) -> DataFrame:
    """(h, c): how often each word's hash stands in the texts (one column)."""
    return written(texts.mapInArrow(trimmed(_counted_words), "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "words")


def frequent(words: DataFrame, most: int) -> Head:
    """The words from the smallest count of at least 2 on for which at most ``most`` remain."""
    # One row per power of two and its sixteenths; so few whatever the counts are.
    steps = words.where("c > 1").groupBy(F.floor(F.log2("c") * 16).alias("step")).agg(
        F.count("*").alias("n"), F.min("c").alias("least")).orderBy(F.desc("step")).collect()
    total, least = 0, None
    for step in steps:
        total += step.n
        if total > most:
            break
        least = step.least
    if least is None:
        return Head(np.empty(0, np.uint64), np.empty(0))
    rows = words.where(F.col("c") >= least).toArrow()
    hashes, counts = rows["h"].to_numpy().view(np.uint64), rows["c"].to_numpy().astype(float)
    order = np.argsort(hashes)
    return Head(hashes[order], counts[order])


def _counted_bits(shared, sizes: list[list[int]], bits: list[int]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [Layer(b, logs) for b, logs in zip(bits, sizes, strict=True)]
        tables = [[np.zeros(2 << log, np.int32) for log in k.logs] for k in kinds]
        found = False
        for batch in batches:
            for _, _, tokens in _chunks(batch, 0, PIECE_BYTES):
                places = shared.value.places(tokens.hashes)
                count_bits(kinds[0], word_symbols(tokens, places), tables[0])
                count_bits(kinds[1], spelled_symbols(tokens, places), tables[1])
                found = True
        if found:
            for number, table in enumerate(t for kind in tables for t in kind):
                for at in range(0, len(table), PIECE):
                    yield pa.RecordBatch.from_pydict({
                        "number": pa.array([number], pa.int32()), "piece": pa.array([at // PIECE], pa.int32()),
                        "counts": pa.array([table[at:at + PIECE].tobytes()], pa.binary())})

    return trimmed(count)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of equal (number, piece, share), which come one after the other, as one; counts become 64 bits wide."""
    key, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "number": pa.array([key[0]], pa.int32()), "piece": pa.array([key[1]], pa.int32()),
            "share": pa.array([key[2]], pa.int64()), "wide": pa.array([True]),
            "counts": pa.array([total.tobytes()], pa.binary())})

    for batch in batches:
        for i in range(batch.num_rows):
            number, piece, share, wide = (batch.column(c)[i].as_py() for c in range(4))
            counts = np.frombuffer(batch.column(4)[i].as_buffer(), np.int64 if wide else np.int32).astype(np.int64)
            if (number, piece, share) == key:
                total += counts
            else:
                if key is not None:
                    yield row()
                key, total = (number, piece, share), counts
    if key is not None:
        yield row()


def context_counts(texts: DataFrame, head: Head, kinds: tuple[Layer, Layer]) -> None:
    """Fill the tables of both layers with the counts of all texts, scaled to 16 bits."""
    spark = texts.sparkSession
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(head)
    counted = texts.coalesce(max(-(-size // TASK_BYTES), 1)).mapInArrow(
        _counted_bits(shared, [k.logs for k in kinds], [k.bits for k in kinds]), "number int, piece int, counts binary")
    # Every task sends one row of each piece, so a piece has as many rows as there were tasks.
    rows = written(counted.withColumn("share", F.shiftright(F.monotonically_increasing_id(), 33)).withColumn(
        "wide", F.lit(False)).select("number", "piece", "share", "wide", "counts"), "context-counts")
    while (rows.agg(F.max("share")).first()[0] or 0) > 0:
        fewer = rows.withColumn("share", F.floor(F.col("share") / FAN_IN))
        rows = written(fewer.repartition("number", "piece", "share").sortWithinPartitions("number", "piece", "share").mapInArrow(
            _added, "number int, piece int, share long, wide boolean, counts binary"), "context-counts")
    tables = [np.zeros(2 << log, np.uint16) for kind in kinds for log in kind.logs]
    for r in rows.toLocalIterator():  # tables of a size that is a parameter
        counts = np.frombuffer(r.counts, np.int64 if r.wide else np.int32).reshape(-1, 2)
        scale = np.maximum(counts.max(axis=1, keepdims=True) / 60_000, 1)
        # What is scaled down keeps at least one.
        small = np.where(counts > 0, np.maximum(counts / scale, 1), 0).astype(np.uint16).reshape(-1)
        tables[r.number][r.piece * PIECE:r.piece * PIECE + len(small)] = small
    for kind in kinds:
        kind.tables, tables = tables[:len(kind.logs)], tables[len(kind.logs):]


def _ended_weights(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, kinds = shared.value
        mixer = Mixer(kinds[0], leave_out=True)
        for batch in batches:
            for _, _, tokens in _chunks(batch, 0):
                mixer.run(word_symbols(tokens, head.places(tokens.hashes)))
        values = np.concatenate([mixer.sums.reshape(-1), mixer.uses])
        yield pa.RecordBatch.from_pydict({"place": pa.array(range(len(values)), pa.int32()), "value": pa.array(values)})

    return trimmed(run)


def first_weights(texts: DataFrame, head: Head, words: Layer) -> None:
    """Set the weights of the words' layer to the mean of those that the lanes of all texts end with."""
    shared = texts.sparkSession.sparkContext.broadcast((head, (words,)))
    rows = texts.mapInArrow(_ended_weights(shared), "place int, value double").groupBy("place").agg(
        F.sum("value").alias("value")).orderBy("place").collect()
    start = np.full((GATES, INPUTS), 0.4)
    if rows:
        values = np.array([r.value for r in rows])
        sums, uses = values[:start.size].reshape(start.shape), values[start.size:]
        # A gate that was hardly used keeps what it started with.
        words.weights = ((sums + 100 * start) / (uses[:, None] + 100)).astype(np.float32)


_SCORED = ("id {0}, row long, n_tokens long, n_bytes long, known long, base double, score double, "
           "tail array<struct<h: long, spelled: double>>")


def _scored(shared, tokens_seen: int, distinct: int):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, kinds = shared.value
        mixers = [Mixer(k) for k in kinds]
        logs = np.log10((head.counts + 0.5) / (tokens_seen + 0.5 * (distinct + 1)))
        for batch in batches:
            for at, n, tokens in _chunks(batch, 2):
                places = head.places(tokens.hashes)
                # Only held-out texts have words never seen, so only their rare words are spelled.
                held = np.repeat(batch.column(4).slice(at, n).to_numpy(zero_copy_only=False), tokens.counts)
                spelled = np.zeros((places < 0).sum())
                spelled[held[places < 0]] = mixers[1].run(spelled_symbols(tokens, np.where(held, places, 0)))
                text = np.repeat(np.arange(n), tokens.counts)
                known = places >= 0
                at_known, of_known = places[known], text[known]
                score = mixers[0].run(word_symbols(tokens, places))
                np.add.at(score, of_known, head.shares[at_known])
                rare = np.bincount(text[~known], minlength=n)
                tail = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(rare)]), pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(tokens.hashes[~known].view(np.int64)), pa.array(spelled)],
                        ["h", "spelled"]))
                part = batch.slice(at, n)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), pa.array(tokens.counts, pa.int64()), part.column(3),
                    pa.array(np.bincount(of_known, minlength=n), pa.int64()),
                    pa.array(np.bincount(of_known, logs[at_known], n).astype(float)), pa.array(score), tail],
                    ["id", "row", "n_tokens", "n_bytes", "known", "base", "score", "tail"])

    return trimmed(score)


def score_texts(df: DataFrame, id: str = "doc_id", text: str = "text", head: int = HEAD, slots: int = SLOTS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of every row.

    At most ``head`` words and tables of ``2 ** slots`` slots are sent to every task.
    """
    rows = df.select(F.col(f"`{id}`").alias("id"), F.monotonically_increasing_id().alias("row"), text_of(text).alias("text"),
                     F.octet_length(text_of(text)).cast("long").alias("n_bytes"), (~training_fold(id)).alias("held_out"))
    learned = rows.where(training_fold("id")).select("text")
    words = word_counts(learned)
    totals = words.agg(F.sum("c").alias("n"), F.count("*").alias("v"), F.count_if(F.col("c") == 1).alias("once")).first()
    n, v = totals.n or 0, totals.v
    frequent_words, kinds = frequent(words, head), layers(n, slots)
    context_counts(learned, frequent_words, kinds)
    first_weights(learned, frequent_words, kinds[0])
    shared = df.sparkSession.sparkContext.broadcast((frequent_words, kinds))
    scored = written(rows.mapInArrow(_scored(shared, n, v), _SCORED.format(dict(df.dtypes)[id])), "scored")
    tail = scored.select("row", F.inline("tail")).groupBy("row", "h").agg(
        F.count("*").alias("times"), F.min("spelled").alias("spelled"))
    seen, times = F.coalesce("c", F.lit(0)), F.col("times")
    never = max(float(totals.once), 0.5)
    rare = n - float(frequent_words.counts.sum())
    rest = tail.join(words, "h", "left").groupBy("row").agg(
        F.sum(F.when(seen > 0, times).otherwise(0)).alias("more"),
        F.sum(times * F.log10((seen + 0.5) / F.lit(n + 0.5 * (v + 1)))).alias("others"),
        F.sum(times * F.log10(F.when(seen > 0, seen).otherwise(F.lit(never)) / F.lit(rare + never))).alias("shares"),
        F.sum(F.when(seen == 0, times * F.col("spelled")).otherwise(0.0)).alias("spelled"))
    out = scored.drop("tail").join(rest, "row", "left").withColumn("score", F.col("score") + F.coalesce("shares", F.lit(0.0)))
    bits = -(F.col("score") + F.coalesce("spelled", F.lit(0.0))) / math.log10(2)
    return out.select(
        "id", (~training_fold("id")).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("others", F.lit(0.0))).alias("base_score"), "score",
        (bits / F.greatest(F.col("n_bytes"), F.lit(1))).alias("bits_per_byte"))

"""Byte-level BPE: encoding by a global shuffle of distinct words, decoding by the token-byte table.

1. Texts are split into pre-tokens. In blocks of about ``BLOCK_BYTES`` of text each distinct word gets a number and
   each text becomes the list of its words' numbers: words and positions, with every word named once per block.
2. The words go to the part their hash names. There each distinct word of the whole table is encoded once, and
   its ids return to the blocks that asked. A word has at most one entry per block, so no word is a hot key.
3. A block and the ids of its words meet again, and the texts are put together by position.

Rows are packed: a block sends one row of words per part, not one per word. Numbers within a block rise with falling
frequency and are kept as bytes of varying number, compressed, so that the positions take about a quarter of the text.

Defined cases: a NULL text counts as empty and has no ids; texts of any length are one row; repeated rows and
missing or repeated row keys are kept as they are; no special tokens, their strings are ordinary text; decoding
ids outside the table raises an error; only the named columns are returned, whatever else the table has.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillflow.llm.common import text_of, written

BLOCK_BYTES = 16 << 20
# Words put together, and bytes decoded, before a task hands them to Spark.
OUT_WORDS = 1 << 18
OUT_BYTES = 4 << 20

# The pattern of the public rank files, and the same pattern for texts of ASCII only, where ``\\s`` is
# [\\t-\\r\\x20], ``\\p{L}`` [A-Za-z] and ``\\p{N}`` [0-9].
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r\x20A-Za-z0-9]+|[\t-\r\x20]+(?![^\t-\r\x20])|[\t-\r\x20]+"""


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a rank file: base64 and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def splitter(pattern: str) -> Callable[[str], list[str]]:
    whole = regex.compile(pattern).findall
    if pattern != PATTERN:
        return whole
    plain = re.compile(ASCII_PATTERN).findall
    return lambda text: plain(text) if text.isascii() else whole(text)


def _compressed(raw: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(raw)


# Numbers are kept as a first byte each: itself below ONE; then the high part of a number of two bytes; then of one of
# three; or ESCAPE for one of four more. The further bytes follow, number by number of each kind.
ONE, HIGH, ESCAPE = 192, 252, 255
TWO = (HIGH - ONE) << 8
THREE = (ESCAPE - HIGH) << 16


def _packed(values: np.ndarray) -> bytes:
    """Numbers below 2**32, compressed."""
    v = values.astype(np.int64)
    two, three = v - ONE, v - ONE - TWO
    kinds = np.searchsorted([ONE, ONE + TWO, ONE + TWO + THREE], v, side="right")
    first = np.select([kinds == 0, kinds == 1, kinds == 2], [v, ONE + (two >> 8), HIGH + (three >> 16)], ESCAPE)
    return _compressed(b"".join([
        first.astype(np.uint8).tobytes(), (two[kinds == 1] & 255).astype(np.uint8).tobytes(),
        (three[kinds == 2] & 65535).astype("<u2").tobytes(), v[kinds == 3].astype("<u4").tobytes()]))


def _unpacked(body: bytes, n: int) -> np.ndarray:
    if not n:
        return np.empty(0, np.int64)
    raw = zstandard.ZstdDecompressor().decompress(body)
    first = np.frombuffer(raw, np.uint8, n)
    out, at = first.astype(np.int64), n
    for chosen, kind, base, offset in (((first >= ONE) & (first < HIGH), "<u1", ONE, ONE),
                                       ((first >= HIGH) & (first < ESCAPE), "<u2", HIGH, ONE + TWO)):
        low = np.frombuffer(raw, kind, int(chosen.sum()), at)
        out[chosen] = ((out[chosen] - base) << 8 * low.itemsize) + low + offset
        at += low.nbytes
    out[first == ESCAPE] = np.frombuffer(raw, "<u4", int((first == ESCAPE).sum()), at)
    return out


def _split_blocks(pattern: str, parts: int, names: list[str], id_type: pa.DataType, block_bytes: int):
    """A function of record batches (key, whole): for each block one row of its texts' word numbers, and for each
    part one row of the block's words there, in order of their numbers."""

    def flush(block: int, keys: list, numbers: list[np.ndarray], words: list[str]) -> Iterator[pa.RecordBatch]:
        flat = np.concatenate(numbers) if numbers else np.empty(0, np.int64)
        # Words of about the same frequency are in order of their bytes, which compresses them well.
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        rarity = (-np.log2(np.maximum(np.bincount(flat, minlength=len(words)), 1)).astype(np.int64)).tolist()
        by_use = sorted(range(len(words)), key=lambda i: (rarity[i], raw[i]))
        rank = np.empty(len(words), np.int32)
        rank[by_use] = np.arange(len(words), dtype=np.int32)
        raw = [raw[i] for i in by_use]
        part = np.fromiter((zlib.crc32(r) % parts for r in raw), np.int64, len(raw))
        rows = [{"block": block, "part": -1, "n": len(flat), "keys": keys, "lengths": [len(a) for a in numbers],
                 "n_words": len(words), "of": _packed(part), "body": _packed(rank[flat])}]
        grouped = np.argsort(part, kind="stable")
        bounds = np.searchsorted(part[grouped], np.arange(parts + 1))
        for p in np.flatnonzero(np.diff(bounds)):
            mine = [raw[i] for i in grouped[bounds[p]:bounds[p + 1]]]
            body = _compressed(b"".join(mine))
            rows.append({"block": block, "part": int(p), "n": sum(map(len, mine)), "keys": None, "lengths": None,
                         "n_words": len(mine), "of": _packed(np.array([len(r) for r in mine])), "body": body})
        yield pa.RecordBatch.from_pylist(rows, schema=_block_schema(names, id_type))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, task, blocks = splitter(pattern), TaskContext.get().partitionId(), count()
        numbering, keys, numbers, held = defaultdict(count().__next__), [], [], 0
        for batch in batches:
            for at in range(batch.num_rows):
                text = batch.column(1)[at].as_py()
                found = find(text)
                numbers.append(np.fromiter(map(numbering.__getitem__, found), np.int32, len(found)))
                keys.append(batch.column(0)[at].as_py())
                held += len(text)
                if held >= block_bytes:
                    yield from flush(task << 32 | next(blocks), keys, numbers, list(numbering))
                    numbering, keys, numbers, held = defaultdict(count().__next__), [], [], 0
        if keys:
            yield from flush(task << 32 | next(blocks), keys, numbers, list(numbering))

    return split


def _block_schema(names: list[str], id_type: pa.DataType) -> pa.Schema:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(id_type), pa.list_(pa.int32()), pa.int64(), pa.binary(), pa.binary()]
    return pa.schema(list(zip(names, kinds, strict=True)))


_NAMES = ["block", "part", "n", "keys", "lengths", "n_words", "of", "body"]


class _Encoded(dict):
    """Word → ids; each word is encoded when first asked for."""

    def __init__(self, encode: Callable[[str], list[int]]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: bytes) -> list[int]:
        ids = self[word] = self.encode(word.decode("utf-8", "surrogatepass"))
        return ids


def _encode_words(pattern: str, ranks):
    """A function of record batches (block, part, n, n_words, of, body), ordered by part: the ids of the words."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        now, known = None, _Encoded(tokenizer.encode_ordinary)
        for batch in batches:
            for row in batch.to_pylist():
                if row["part"] != now:
                    now, known = row["part"], _Encoded(tokenizer.encode_ordinary)
                text = zstandard.ZstdDecompressor().decompress(row["body"])
                ends = np.cumsum(_unpacked(row["of"], row["n_words"])).tolist()
                words = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
                found = [known[w] for w in words]
                flat = np.fromiter(chain.from_iterable(found), np.int64)
                yield pa.RecordBatch.from_pydict({
                    "block": [row["block"]], "part": [row["part"]], "n_words": [len(found)], "n_ids": [len(flat)],
                    "counts": [_packed(np.fromiter(map(len, found), np.int64, len(found)))], "ids": [_packed(flat)]},
                    schema=pa.schema([("block", pa.int64()), ("part", pa.int32()), ("n_words", pa.int64()),
                                      ("n_ids", pa.int64()), ("counts", pa.binary()), ("ids", pa.binary())]))

    return encode


def _put_together(key: str, id_type: pa.DataType):
    """A function of record batches (block, n, keys, lengths, n_words, of, body, answers): each text's ids."""

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                answers = sorted(row["answers"] or [], key=lambda a: a["part"])
                none = np.empty(0, np.int64)
                counts = np.concatenate([none, *[_unpacked(a["counts"], a["n_words"]) for a in answers]])
                flat = np.concatenate([none, *[_unpacked(a["ids"], a["n_ids"]) for a in answers]]).astype(np.int32)
                # The answers list the words by part; back to the words' numbers.
                grouped = np.argsort(_unpacked(row["of"], row["n_words"]), kind="stable")
                n_ids, first = np.empty(row["n_words"], np.int64), np.empty(row["n_words"], np.int64)
                n_ids[grouped], first[grouped] = counts, np.cumsum(counts) - counts
                places = _unpacked(row["body"], row["n"])
                upto = np.concatenate([[0], np.cumsum(row["lengths"])]).astype(np.int64)
                doc, docs = 0, len(row["keys"])
                while doc < docs:
                    end = doc + 1  # as many texts as stay below OUT_WORDS words, one at least
                    while end < docs and upto[end + 1] - upto[doc] <= OUT_WORDS:
                        end += 1
                    mine = places[upto[doc]:upto[end]]
                    size = n_ids[mine]
                    ends = np.cumsum(size)
                    total = int(ends[-1]) if len(ends) else 0
                    ids = flat[np.repeat(first[mine] - (ends - size), size) + np.arange(total)]
                    cuts = np.concatenate([[0], ends])[upto[doc:end + 1] - upto[doc]].astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["keys"][doc:end], id_type), pa.ListArray.from_arrays(cuts, pa.array(ids, pa.int32()))],
                        [key, "ids"])
                    doc = end

    return assemble


def encode(df: DataFrame, ranks: dict[bytes, int], key: str = "doc_id", text: str = "text", pattern: str = PATTERN,
           parts: int | None = None, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, ids array<int>), one row for each row of ``df``.

    ``parts`` is how many ways the distinct words are spread; a task holds the distinct words of one part, so it
    should grow with the data, as its default ``spark.sql.shuffle.partitions`` does.
    """
    spark: SparkSession = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    plain = df.select(F.col(f"`{key}`").alias("key"), text_of(text).alias("whole"))
    key_ddl = plain.schema["key"].dataType.simpleString()
    id_type = to_arrow_type(plain.schema["key"].dataType)
    table = spark.sparkContext.broadcast(ranks)  # the vocabulary, which does not grow with the data

    blocks = written(plain.mapInArrow(
        _split_blocks(pattern, parts, _NAMES, id_type, block_bytes),
        f"block long, part int, n long, keys array<{key_ddl}>, lengths array<int>, n_words long, of binary, body binary"),
        "blocks")
    asked = blocks.where("part >= 0").select("block", "part", "n", "n_words", "of", "body")
    answers = asked.repartition("part").sortWithinPartitions("part").mapInArrow(
        _encode_words(pattern, table), "block long, part int, n_words long, n_ids long, counts binary, ids binary")
    back = answers.groupBy("block").agg(F.collect_list(
        F.struct("part", "n_words", "n_ids", "counts", "ids")).alias("answers"))
    both = blocks.where("part < 0").drop("part").join(back, "block", "left")
    return both.mapInArrow(_put_together(key, id_type), f"`{key}` {key_ddl}, ids array<int>")


def decode(df: DataFrame, ranks: dict[bytes, int], ids: str = "ids", result: str = "decoded") -> DataFrame:
    """``df`` with ``result``: the bytes of the ids, each looked up in the token-byte table; NULL ids give no bytes."""
    table = df.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    kept = [c for c in df.columns if c != result]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = table.value.__getitem__
        for batch in batches:
            column, texts, held, first = batch.schema.get_field_index(ids), [], 0, 0
            for at in range(batch.num_rows):
                found = batch.column(column)[at].values
                texts.append(b"".join(map(token, found.to_numpy(zero_copy_only=False).tolist() if found is not None else ())))
                held += len(texts[-1])
                if held >= OUT_BYTES or at == batch.num_rows - 1:
                    part = batch.slice(first, len(texts))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, result])
                    texts, held, first = [], 0, at + 1

    schema = df.select(*[F.col(f"`{c}`") for c in kept]).schema.add(result, "binary")
    return df.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)

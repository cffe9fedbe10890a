import math
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import DOCS, ODD, docs
from tillflow.llm import mixing, queries


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        low = low.replace(c, " ")
    return [*(w for w in low.split(" ") if w), None]


def learned(id):
    return id is not None and zlib.crc32(str(id).encode()) % 5 != 1


def base(rows):
    """(n_tokens, n_known, N, base score) per row, straight from the definition."""
    c = Counter(t for i, text in rows if learned(i) for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return [(len(t := tokens(text)), sum(c[x] > 0 for x in t), n, sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in t))
            for _, text in rows]


def corpus(n, seed=3):
    """Texts of words that often follow each other, with rare words in between."""
    draw = random.Random(seed)
    common = [f"word{i}" for i in range(200)]
    follows = {w: draw.sample(common, 3) for w in common}
    out = []
    for _ in range(n):
        word, text = draw.choice(common), []
        for _ in range(draw.randrange(20, 400)):
            text.append(word if draw.random() > 0.03 else f"rare{draw.randrange(10**6)}é")
            word = draw.choice(follows[word])
        out.append(" ".join(text).capitalize())
    return out


def check(spark, frame, rows, **options):
    found = sorted(mixing.score_texts(frame, **options).collect(), key=lambda r: (str(r.id), r.base_score))
    want = sorted(((str(i), *b) for (i, _), b in zip(rows, base(rows), strict=True)), key=lambda r: (r[0], r[4]))
    assert [(str(r.id), r.n_tokens, r.n_known, r.train_tokens) for r in found] == [w[:4] for w in want]
    np.testing.assert_allclose([r.base_score for r in found], [w[4] for w in want], rtol=1e-9)
    assert all(r.held_out == (not learned(r.id)) and -math.inf < r.score <= 0 for r in found)
    return found


def test_never_seen_words_cost_bits_by_their_length(spark):
    texts = [*["a b c d"] * 40, "a zz d", "a " + "qwertzuiop" * 30 + " d"]
    ids = [*[next(i for i in range(99) if learned(i))] * 40, *[i for i in range(99) if not learned(i)][:2]]
    short, long = sorted((r for r in mixing.score_texts(docs(spark, texts, ids)).collect() if r.held_out), key=lambda r: r.id)
    assert short.score == pytest.approx(long.score, rel=1e-3)
    assert long.bits_per_byte * len(texts[-1]) > 3 * short.bits_per_byte * len(texts[-2])


def test_base_equals_definition_and_context_helps(spark):
    texts = corpus(300)
    found = check(spark, docs(spark, texts).repartition(4), list(enumerate(texts)))
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > 0.7 * sum(r.base_score for r in held)
    assert all(r.score > r.base_score for r in held)


def test_small_head_small_tables_odd_texts_and_ids(spark):
    texts = [*ODD, *corpus(20), " ".join(["again"] * 5000), "x" * 100_000, "\x85 a b C"]
    ids = [None if i % 6 == 5 else 9 if i % 6 == 4 else i for i in range(len(texts))]
    frame = docs(spark, texts, ids)
    rows = list(zip(ids, texts, strict=True))
    check(spark, frame.unionAll(frame), rows + rows, head=50, slots=16)


@pytest.mark.parametrize("texts, ids", [([], []), (["a b", None], [None, None]), ([None], [2])])
def test_without_training_texts(spark, texts, ids):
    check(spark, docs(spark, texts, ids), list(zip(ids, texts, strict=True)))


def test_score_does_not_depend_on_partitions(spark):
    texts = corpus(60)
    one, many = ({r.id: r.score for r in mixing.score_texts(docs(spark, texts).repartition(k)).collect()} for k in (1, 7))
    np.testing.assert_allclose([one[i] for i in range(60)], [many[i] for i in range(60)], rtol=1e-4)


def test_tokens_and_hashes(monkeypatch):
    texts = ["", "Ab  c\tab", " ", "one", "c", "long" * 50, "", "Ab"]
    data = "".join(texts).encode()
    bounds = np.cumsum([0, *[len(t) for t in texts]])
    for piece in (1 << 20, 4):
        monkeypatch.setattr(mixing, "PIECE_BYTES", piece)
        got = mixing.tokens_of(np.frombuffer(data, np.uint8), bounds)
        assert got.counts.tolist() == [1, 4, 1, 2, 2, 2, 1, 2]
        words = [bytes(got.data[s:s + n]).decode() for s, n in zip(got.starts, got.lengths, strict=True)]
        assert words == ["", "ab", "c", "ab", "", "", "one", "", "c", "", "long" * 50, "", "", "ab", ""]
        assert len(set(zip(words, got.hashes.tolist(), strict=True))) == len(set(words)) == len(set(got.hashes.tolist()))


def plain_score(layer, symbols):
    """The same mixing bit by bit in plain Python: log10 per text."""
    out, at = [], 0
    for count in symbols.counts:
        total = 0.0
        for begin in range(at, at + count, mixing.LANE):
            weights = layer.weights.astype(float).copy()
            for i in range(begin, min(begin + mixing.LANE, at + count)):
                for bit in range(symbols.depths[i]):
                    value = symbols.values[i:i + 1]
                    one = int(value[0]) >> (layer.bits - 1 - bit) & 1
                    inputs, seen = [], []
                    for j, table in enumerate(layer.tables):
                        context = None if j == 0 else symbols.contexts[j][i:i + 1]
                        slot = int(layer.bases(j, bit // 4, context, value)[0] + layer.inner(bit, value)[0])
                        zeros, ones = int(table[2 * slot]), int(table[2 * slot + 1])
                        inputs.append(math.log((ones + 0.4) / (zeros + 0.4)))
                        seen.append(sum(zeros + ones >= k for k in (1, 3, 16)))
                    gate = seen[-2] + 4 * seen[-1] + 16 * (bit == 0)
                    inputs = np.array([*inputs, 0.3])
                    p = 1 / (1 + math.exp(-min(max(weights[gate] @ inputs, -12), 12)))
                    total += math.log10(p if one else 1 - p)
                    weights[gate] += (one - p) * float(mixing.RATE) * inputs
        out.append(total)
        at += count
    return out


def test_lanes_equal_plain_mixing(monkeypatch):
    monkeypatch.setattr(mixing, "LANE", 40)
    data = [t.encode() for t in corpus(6, seed=8)]
    tokens_ = mixing.tokens_of(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *[len(d) for d in data]]))
    hashes, counts = np.unique(tokens_.hashes, return_counts=True)
    head = mixing.Head(hashes[counts > 3], counts[counts > 3].astype(float))
    places = head.places(tokens_.hashes)
    assert ((places >= 0) == np.isin(tokens_.hashes, head.hashes)).all()
    for layer, symbols in zip(mixing.layers(5000, 16), (mixing.word_symbols(tokens_, places), mixing.spelled_symbols(tokens_, places)),
                              strict=True):
        layer.tables = [np.zeros(2 << log, np.uint16) for log in layer.logs]
        mixing.count_bits(layer, symbols, layer.tables)
        layer.weights = np.random.default_rng(1).uniform(0.1, 0.5, (32, len(layer.logs) + 1)).astype(np.float32)
        np.testing.assert_allclose(mixing.Mixer(layer).run(symbols), plain_score(layer, symbols), rtol=1e-4)


def test_counting_holds_few_events_at_once():
    draw, n = np.random.default_rng(9), 600_000
    layer = mixing.layers(1 << 20, 20)[0]
    depths = np.where(draw.random(n) < 0.7, layer.bits, 1).astype(np.int32)
    contexts = [None, *[draw.integers(0, 5000, n).astype(np.uint64) for _ in range(2)]]
    symbols = mixing.Symbols(draw.integers(0, 2**layer.bits, n).astype(np.int32), depths, contexts, np.array([n]))
    tables = [np.zeros(2 << log, np.int32) for log in layer.logs]
    tracemalloc.start()
    mixing.count_bits(layer, symbols, tables)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 << 20  # the events of one table alone are 13 MB, in 64 bits 26 MB
    for j, table in enumerate(tables):
        want = np.zeros_like(table)
        for bit in range(layer.bits):
            deep = depths > bit
            values, context = symbols.values[deep], None if j == 0 else contexts[j][deep]
            slots = layer.bases(j, bit // 4, context, values) + layer.inner(bit, values)
            want += np.bincount(2 * slots + layer.one(bit, values), minlength=len(table)).astype(np.int32)
        assert (table == want).all()


def test_probabilities_of_all_next_symbols_add_up_to_one():
    layer = mixing.layers(100, 16)[1]
    draw = np.random.default_rng(4)
    layer.tables = [draw.integers(0, 9, 2 << log).astype(np.uint16) for log in layer.logs]
    mixer, total = mixing.Mixer(layer), 0.0
    for value in range(256):
        context = [None, *[np.full(1, k, np.uint64) for k in (5, 6)]]
        total += 10 ** mixer.run(mixing.Symbols(np.array([value]), np.array([8]), context, np.array([1])))[0]
    assert abs(total - 1) < 1e-4


def test_tables_are_summed_over_tasks(spark, monkeypatch):
    texts = corpus(80)
    frame = docs(spark, texts).repartition(7).select(mixing.text_of().alias("text"))
    head = mixing.frequent(mixing.word_counts(frame), 1000)
    alone, apart = mixing.layers(20_000, 16), mixing.layers(20_000, 16)
    mixing.context_counts(frame, head, alone)
    monkeypatch.setattr(mixing, "TASK_BYTES", 1)
    monkeypatch.setattr(mixing, "FAN_IN", 2)
    mixing.context_counts(frame, head, apart)
    for a, b in zip(alone, apart, strict=True):
        assert all((x == y).all() for x, y in zip(a.tables, b.tables, strict=True)) and a.tables[0].sum()


def test_empty_table(spark):
    assert mixing.score_texts(spark.createDataFrame([], DOCS)).collect() == []


def test_query_covers_all_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    found = {r.doc_id: r for r in queries.op12_mixing(spark, "/root/testdata/sf0.001").collect()}
    for (i, text), (n, known, total, score) in zip(rows, base(rows), strict=True):
        assert (found[i].n_tokens, found[i].n_known, found[i].train_tokens) == (n, known, total)
        assert abs(found[i].base_score - score) < 1e-6 * abs(score)

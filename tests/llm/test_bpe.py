import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import DOCS, ODD, docs, prose
from tillflow.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
LIBRARY = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
TEXTS = [*ODD, "don't we'll I'M 12,345 ...!! \t\n  x  ", "a\x00b\x1cc\x85d\xa0e　f", "<|endoftext|> <|x|>", "  ", "\n\n a",
         "'s 's 't", "x" * 3000, " " * 3000 + "y", prose(1, 9000), *["copy of a text"] * 40, "日本語 текст \U0001F468‍\U0001F469‍\U0001F467"]


@pytest.mark.parametrize("parts, block_bytes", [(None, bpe.BLOCK_BYTES), (3, 1), (50, 400)])
def test_equals_the_library_and_comes_back(spark, parts, block_bytes):
    ids = [None if i % 5 == 0 else 7 if i % 5 == 1 else i for i in range(len(TEXTS))]
    frame = docs(spark, TEXTS, ids).withColumnRenamed("lang", "ids").withColumnRenamed("start", "block")
    out = bpe.decode(bpe.encode(frame, RANKS, parts=parts, block_bytes=block_bytes), RANKS).collect()
    got = sorted((str(r.doc_id), list(r.ids), bytes(r.decoded)) for r in out)
    whole = [t or "" for t in TEXTS]
    assert got == sorted((str(i), LIBRARY.encode_ordinary(t), t.encode()) for i, t in zip(ids, whole, strict=True))


def test_empty_table_null_ids_and_unknown_ids(spark):
    assert bpe.encode(spark.createDataFrame([], DOCS), RANKS).count() == 0
    frame = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in bpe.decode(frame, RANKS).collect()] == [b"", b""]
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(spark.createDataFrame([(1, [10**6])], "doc_id long, ids array<int>"), RANKS).collect()


@given(st.text(alphabet=[chr(c) for c in range(128)], max_size=60))
@settings(max_examples=300, deadline=None)
def test_ascii_pattern_splits_alike(text):
    import regex
    assert bpe.splitter(bpe.PATTERN)(text) == regex.findall(bpe.PATTERN, text)


@given(st.lists(st.one_of(st.integers(0, 400), st.integers(0, 300_000), st.integers(0, 2**32 - 1)), max_size=80))
@settings(max_examples=200, deadline=None)
def test_numbers_come_back(values):
    assert bpe._unpacked(bpe._packed(np.array(values, np.int64)), len(values)).tolist() == values


def test_each_distinct_word_is_encoded_once():
    asked = []
    known = bpe._Encoded(lambda w: asked.append(w) or [1])
    assert [known[w] for w in (b"a", b"b", b"a")] == [[1]] * 3 and asked == ["a", "b"]

"""The pipeline, stage by stage on its own input, and the queries beside their SQL."""

import os
import re

import check
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.test_decontaminate import plain as plain_decontamination
from tests.llm.test_minhash import plain as plain_components
from tests.llm.test_spans import BASE_SECRETS
from tillflow.llm.bpe import read_ranks
from tillflow.llm.common import written
from tillflow.llm.oracles import ORACLES
from tillflow.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@pytest.fixture(scope="module")
def outputs(spark):
    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), []
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        out.append(docs)
    return out


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_columns_and_run(spark, outputs):
    assert all(o.columns == corpus_pipeline.COLUMNS for o in outputs[:-1])
    last, ran = by_id(outputs[-1]), by_id(corpus_pipeline.run(spark, SF_DIR))
    assert {k: (r.n_tokens, r.ids) for k, r in last.items()} == {k: (r.n_tokens, r.ids) for k, r in ran.items()}


def test_quality_keeps_what_is_labelled_good(spark, outputs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = set(by_id(outputs[1]))
    right = [(i in kept) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.97


def test_near_dedup_keeps_one_of_each_component(outputs):
    rows = sorted(by_id(outputs[1]).items())
    want = plain_components([i for i, _ in rows], [r.text for _, r in rows], 5)
    assert set(by_id(outputs[2])) == {i for i, _, component in want if i == component}


def test_decontamination_drops_exactly_the_contaminated(spark, outputs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    rows = sorted(by_id(outputs[2]).items())
    hits = plain_decontamination([r.text for _, r in rows], items)
    assert set(by_id(outputs[3])) == {i for (i, _), (_, hit, _) in zip(rows, hits, strict=True) if not hit}


def test_secrets_are_marked_and_the_rest_is_untouched(outputs):
    before, after = by_id(outputs[3]), by_id(outputs[4])
    assert set(before) == set(after)
    for i, r in after.items():
        spans = [(m.start(), m.end()) for _, p, g, n in BASE_SECRETS for m in re.finditer(p, before[i].text or "") if len(m[g]) >= n]
        if not spans:
            assert r.text == before[i].text
        else:
            assert "[secret]" in r.text and all(before[i].text[a:b] not in r.text for a, b in spans)
        assert r.n_chars == len(r.text or "")


def test_encoding_is_the_library_s(outputs):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=read_ranks(corpus_pipeline.RANK_FILE))
    docs, last = by_id(outputs[4]), by_id(outputs[5])
    assert {i: list(r.ids) for i, r in last.items()} == {i: library.encode_ordinary(r.text or "") for i, r in docs.items()}


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    count, difference = check.compare(spark, check.connect(SF_DIR), name, SF_DIR)
    assert not difference and count > 0


def test_every_operator_has_its_query():
    assert [re.match(r"op(\d+)_", q)[1] for q in QUERIES] == [str(n) for n in range(1, 11)]
    assert {*QUERIES, "pipeline"} <= set(contract.queries())

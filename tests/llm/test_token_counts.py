import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from rulebeam.llm import token_counts
from rulebeam.llm.token_counts import Vocabulary, add_token_counts, op5_token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(MODEL)


def brute(texts):
    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=MODEL).encode(texts)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t▁é中<s>. \U0001f600the\x00", max_size=30), max_size=5))
def test_same_as_library_on_odd_texts(texts):
    v = test_same_as_library_on_odd_texts.__dict__.setdefault("v", Vocabulary(MODEL))
    assert v.count(texts) == brute(texts)


def test_whole_tokens_are_most_of_the_vocabulary(vocabulary):
    assert len(vocabulary.whole) > 25_000
    assert " the" in vocabulary.whole


def test_small_memo_gives_the_same(vocabulary, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 2)
    texts = [f"zqx{i} vvkw{i}" for i in range(20)]
    assert [n for t in texts for n in vocabulary.count([t])] == brute(texts)


def test_query_matches_library(spark):
    got = {r.doc_id: r for r in op5_token_counts(spark, SF001).collect()}
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d, n in zip(docs, brute([d.text or "" for d in docs])):
        r = got[d.doc_id]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((d.text or "").encode()), n, n > 4096)


def test_nulls_empty_long_repeats_and_clashing_columns(spark):
    rows = [Row(doc_id=1, text=None, n_tokens="x"), Row(doc_id=None, text="", n_tokens="x"),
            Row(doc_id=2, text="a b", n_tokens="x"), Row(doc_id=2, text="a b", n_tokens="x"),
            Row(doc_id=3, text="word " * 500_000, n_tokens="x")]
    schema = "doc_id long, text string, n_tokens string"
    got = sorted(((r.doc_id or 0, r.n_tokens, r.over_limit) for r in
                  add_token_counts(spark.createDataFrame(rows, schema), MODEL).collect()))
    assert got[:4] == [(0, 0, False), (1, 0, False), (2, 2, False), (2, 2, False)]
    assert got[4][1] == brute([rows[4].text])[0] and got[4][2]
    assert add_token_counts(spark.createDataFrame([], schema), MODEL).count() == 0

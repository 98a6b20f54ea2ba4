"""Token counts against the tokenizer library."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paylake.llm import token_counts
from paylake.llm.queries import op11_token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def expected(library, rows):
    out = []
    for r in rows:
        text = r.text or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        out.append((repr(r.doc_id), len(text.encode()), n, n > token_counts.LIMIT))
    return sorted(out)


def got(df):
    return sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect())


@pytest.mark.parametrize("hot", [0, 5, 65_536])
def test_counts_equal_the_library(odd, library, monkeypatch, hot):
    monkeypatch.setattr(token_counts, "HOT", hot)
    assert got(token_counts.count(odd, PATH)) == expected(library, odd.select("doc_id", "text").collect())


def test_long_pre_tokens_and_added_tokens(spark, library, monkeypatch):
    monkeypatch.setattr(token_counts, "HOT", 3)
    texts = ["a" * 64, "a" * 65, "é" * 200, "é" * 200 + "x", "-" * 3_000, "x <|endoftext|> y", "<|endoftext|><|endoftext|>", " <|endoftext|", "a\0b\0", "\0"]
    df = spark.createDataFrame(list(enumerate(texts * 3)), "doc_id bigint, text string")
    assert got(token_counts.count(df, PATH)) == expected(library, df.collect())


def test_whole_table(spark, sf, corpus, library):
    assert got(op11_token_counts(spark, sf)) == expected(library, corpus.select("doc_id", "text").collect())


def test_every_distinct_pre_token_is_counted_once(spark, corpus):
    rows = token_counts.pieces(corpus.select("text"), PATH).groupBy("name").count().where("count > 1")
    assert rows.isEmpty()


def test_empty_table_and_wrong_kind(spark, empty):
    assert token_counts.count(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        token_counts._Model(public_tokenizers.path("word_bpe_49k.json"))

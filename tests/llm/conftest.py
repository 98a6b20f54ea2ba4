import os
import random

import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and to in is that for on with as by it be at from this are an or was".split()


@pytest.fixture(scope="session")
def ranks():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="session")
def sf():
    return os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


@pytest.fixture(scope="session")
def corpus(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd_texts():
    """Null, empty, blank, short and very long texts, and texts with every kind of character."""
    rnd = random.Random(3)
    bits = ["'", "s", "t", "re", "ve", " ", "  ", "\n", "\t", "a", "B", "é", "7", "½", "!", "..", "　", "ß", "日", "'ll", "'d",
            "́", "😀", "\x1c", "\x85", "'r", "ſ", "Ᲊ", "<|endoftext|>"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30))) for _ in range(300)]
    long = " ".join(rnd.choice(WORDS) for _ in range(60_000))
    return [None, "", " \n\t ", "one", "One Two", "a" * 5_000, " " * 3_000 + "x", "'" * 500, "日本" * 3_000, long, *made]


@pytest.fixture(scope="session")
def odd(spark, odd_texts):
    """Odd texts with null, repeated and negative ids, repeated rows, and extra columns of clashing names."""
    rows = [(i, t, None if i % 3 else "en", None if i % 4 else "b", None) for i, t in enumerate(odd_texts)]
    rows += [(None, "a text without an id", "en", "a", 5), (None, "a text without an id", "en", "a", 5), (-7, "One Two", "de", "a", 7), (3, "one", "en", None, 3), (3, "one", "en", None, 3)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    extra = {c: df["source"] for c in ("size", "component", "node", "ids", "kept", "key", "place", "row", "kind", "score", "text_sha256", "member", "task")}
    return df.withColumns(extra)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)

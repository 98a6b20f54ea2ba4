"""Byte BPE and token files against the libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from paylake.llm import bpe, known, pretokens, token_files


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=pretokens.ranks(ranks), special_tokens={})


@pytest.mark.parametrize("window", [1 << 20, 1_000, 7])
def test_ids_equal_the_library(odd_texts, ranks, library, monkeypatch, window):
    monkeypatch.setattr(pretokens, "WINDOW", window)
    texts = [t or "" for t in odd_texts if window > 100 or len(t or "") < 1_000]
    assert bpe.encode_texts(texts, ranks) == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_pieces_of_one_hash_are_told_apart(odd_texts, ranks, library, monkeypatch):
    monkeypatch.setattr(pretokens, "_powers", (np.zeros(1 << 21, np.uint64), np.zeros(1 << 21, np.uint64)))
    texts = [t or "" for t in odd_texts if len(t or "") < 1_000]
    assert bpe.encode_texts(texts, ranks) == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]


def test_scan_does_not_depend_on_where_it_is_cut():
    symbols = np.random.default_rng(1).integers(0, pretokens.SYMBOLS, 3_000).astype(np.uint8)
    whole, end = pretokens.states(symbols, pretokens.START)
    first, state = pretokens.states(symbols[:1_234], pretokens.START)
    second, last = pretokens.states(symbols[1_234:], state)
    assert (np.concatenate([first, second]) == whole).all() and last == end


def test_any_run_of_tokens_decodes(ranks):
    text = "Il était une fois… 日本語 it's 12\n\n ok"
    ids = bpe.encode_texts([text], ranks)[0]
    starts = bpe.token_starts(ids, ranks)
    at = np.frombuffer(starts, "<u4")
    assert bpe.decode_tokens(ids, starts, ranks).decode() == text
    assert bpe.decode_tokens(ids[8:20], starts[8:20], ranks) == text.encode()[at[2]:at[5]]
    with pytest.raises(ValueError):
        bpe.decode_tokens(ids, starts[::-1], ranks)


def test_round_trip_of_whole_table(odd, ranks, library):
    for df in (odd,):
        want = sorted((repr(r.doc_id), len(i := library.encode_ordinary(r.text or "")), hashlib.sha256(np.array(i, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((r.text or "").encode()).hexdigest()) for r in df.collect())
        assert sorted((repr(r[0]), *r[1:]) for r in bpe.round_trip(df, ranks).collect()) == want


def test_decode_is_a_step_of_its_own(odd, ranks):
    got = bpe.decode(bpe.encode(odd.limit(20), ranks), ranks).select("doc_id", "decoded").collect()
    assert sorted(bytes(r.decoded) for r in got) == sorted((r.text or "").encode() for r in odd.limit(20).collect())


def test_token_files(spark, odd, odd_texts):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = token_files.written_and_read(spark, odd, path).collect()
    known = odd.select("doc_id", "text").collect()
    assert len(rows) == len(known)
    texts = {r.doc_id: r.text or "" for r in known if r.doc_id is not None}
    rows.sort(key=lambda r: r.start)
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    start = 0
    for r in rows:
        own = [*library.encode(texts.get(r.doc_id, "a text without an id"), add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<i4").tobytes()))
        start += len(own)


def test_added_tokens_as_the_library_has_them(spark, tmp_path):
    from paylake.llm.queries import op8_token_files

    texts = ["x <|endoftext|> y", "<|endoftext|><|endoftext|>", "plain", "", " <|endoftext|", "it's<|endoftext|>'s 12 é", None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    library, start = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), 0
    for r in sorted(op8_token_files(spark, str(tmp_path)).collect(), key=lambda r: r.doc_id):
        own = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<i4").tobytes()))
        start += len(own)


class Counting:
    """A tokenizer library's model that counts how often it is asked."""

    def __init__(self, model):
        self.model, self.asked = model, 0

    def tokenize(self, piece):
        self.asked += 1
        return self.model.tokenize(piece)


def test_a_worker_asks_the_library_once_for_each_pre_token(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = token_files._Library(path)
    library.model = Counting(library.model)
    monkeypatch.setattr(token_files, "_library", lambda path: library)
    letters = "abcdefghijklmnopqrst"
    texts = [" ".join(["", *(a + b + c + d + e for c in letters for d in letters for e in "abcdefgh")]) for a in "bcdfghjklmnp" for b in letters[:15]]
    first, asked = [], []
    for _ in range(2):
        run = [zlib.crc32(ids) for ids in token_files.encode_texts(texts, path, None)]
        assert not first or run == first
        first = run
        asked.append(library.model.asked)
    assert asked == [len(texts) * 20 * 20 * 8] * 2


@pytest.mark.parametrize(("cache", "long"), [(1 << 20, 16 << 20), (64, 3_000), (8, 0)])
def test_what_a_worker_keeps_does_not_change_the_ids(odd_texts, monkeypatch, cache, long):
    monkeypatch.setattr(known, "CACHE", cache)
    monkeypatch.setattr(known, "LONG_CACHE", long)
    monkeypatch.setattr(pretokens, "WINDOW", 300)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files._Library(path)
    library.encode_special_tokens = True
    bits = ["a\0", "\0", "\0\0", "a" * 7, "a" * 8, "a" * 15, "a" * 16, "a" * 14 + "b", "привет", "предложение", "-" * 15, "日本語日本語", "x" * 201]
    texts = [t or "" for t in odd_texts if len(t or "") < 1_000] + [f"{a} {b}{a}" for a in bits for b in bits]
    for some in (texts, texts[::-1], texts):
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<i4").tobytes() for t in some]
        assert list(token_files._plain(some, own)) == want


def test_pre_tokens_whose_places_meet_are_told_apart(monkeypatch):
    monkeypatch.setattr(known, "CACHE", 256)
    monkeypatch.setattr(known.Known, "_place", lambda self, low, high: np.zeros(len(low), np.intp) + len(self.slot) - 3)
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, own = Tokenizer.from_file(path), token_files._Library(path)
    texts = [" ".join(chr(97 + i % 26) * n for n in range(1, 13)) for i in range(60)]
    for some in (texts[:30], texts[20:], texts):
        want = [np.array(library.encode(t, add_special_tokens=False).ids, "<i4").tobytes() for t in some]
        assert list(token_files._plain(some, own)) == want


def test_files_allow_selective_reads(spark, corpus, tmp_path):
    import pyarrow.parquet as pq

    folder = str(tmp_path / "tokens")
    token_files.write(corpus, folder, public_tokenizers.path("byte_bpe_50k.json"))
    parts = sorted(p for p in (tmp_path / "tokens").iterdir() if p.name.startswith("part-"))
    group = pq.ParquetFile(parts[0]).metadata.row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert columns["doc_id"].has_offset_index and columns["doc_id"].has_column_index
    assert any("DICTIONARY" in e for e in columns[next(c for c in columns if c.startswith("tokens"))].encodings)
    plan = token_files.read(spark, folder).select("doc_id", "n_tokens")._jdf.queryExecution().executedPlan().toString()
    assert "tokens:array" not in plan


def test_empty_tables(spark, empty, ranks):
    assert bpe.round_trip(empty, ranks).count() == 0
    assert token_files.written_and_read(spark, empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0

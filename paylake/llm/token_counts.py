"""Token counts of documents, from the counts of their distinct pre-tokens.

No piece crosses a pre-token, so the tokens of a text are the sum of those of its pre-tokens. The
model is asked once for each distinct pre-token of the whole table. The answers are joined to the
pre-tokens of each document with their frequencies, and the products are summed; no list of ids is
made.

The join has two sides of one plan. Pre-tokens that are in most documents, which would be hot keys,
are looked up in a dictionary of HOT names of at most NAME bytes, the size of which does not depend
on the table. What is left, at most about 1 / HOT of all pairs for any of them, is shuffled by name.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from paylake.llm import pretokens
from paylake.llm.batches import parts
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

HOT = 65_536  # names in the dictionary that every worker holds
NAME = 64  # bytes of a name; a longer pre-token is known by a byte that UTF-8 lacks and its SHA-256
LIMIT = 1024
PAIRS = "doc_id bigint, n_bytes bigint, known bigint, rest array<struct<name: binary, n: bigint>>"


class _Model:
    """The tokenizer library's model, asked for numbers of tokens of pre-tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            shape = json.load(f)
        split = shape["pre_tokenizer"] or {}
        if split.get("type") != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True) or shape["normalizer"]:
            raise ValueError("a byte-level tokenizer without prefix space or normalizer is needed")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in shape["added_tokens"]):
            raise ValueError("added tokens that take white space or whole words are not supported")
        self.model = Tokenizer.from_file(path).model
        self.added = sorted((t["content"] for t in shape["added_tokens"]), key=len, reverse=True)
        # Bytes that are printable stand for themselves, the others for 256 and so on in turn.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}

    def count(self, piece: bytes) -> int:
        return len(self.model.tokenize(piece.decode("latin-1").translate(self.letters)))


@functools.cache
def _model(path: str) -> _Model:
    return _Model(path)


def _named(pieces: list[bytes]) -> list[bytes]:
    return [p if len(p) <= NAME else b"\xff" + hashlib.sha256(p).digest() for p in pieces]


def segments(texts: list[str], added: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """What is left of the texts between added tokens, the text of each segment, and the number of
    added tokens in each text. The longest of several that begin at one place counts."""
    out, owner, held = [], [], np.zeros(len(texts), np.int64)
    pattern = re.compile("|".join(map(re.escape, added))) if added else None
    for i, t in enumerate(texts):
        some = pattern.split(t) if pattern and any(a in t for a in added) else [t]
        held[i] = len(some) - 1
        out += some
        owner += [i] * len(some)
    return out, np.array(owner, np.int64), held


def frequencies(texts: list[str]) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]]:
    """For each group of texts: its distinct pre-tokens, and text, pre-token and frequency of each
    pair that occurs."""
    table, done = pretokens.classes(), 0
    for run in pretokens.groups(texts):
        found, which, last = pretokens.distinct(run, table)
        real = np.ones(len(which), bool)
        real[last] = False  # the bytes between the texts
        owner = np.repeat(np.arange(len(run)), np.diff(last, prepend=-1))
        pair, n = np.unique(owner[real] * len(found) + which[real], return_counts=True)
        yield found, done + pair // len(found), pair % len(found), n
        done += len(run)


def pieces(texts: DataFrame, path: str) -> DataFrame:
    """name, docs and tokens of every distinct pre-token of a column ``text``.

    ``docs`` counts the documents that hold it, a text with added tokens once for each segment.
    """

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, some in parts(batches):
            for found, _, piece, _ in frequencies(segments(some, _model(path).added)[0]):
                docs = np.bincount(piece, minlength=len(found))
                here = np.flatnonzero(docs).tolist()
                own = [found[i] for i in here]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_named(own), pa.binary()), pa.array([p if len(p) > NAME else None for p in own], pa.binary()), pa.array(docs[here])],
                    ["name", "long", "docs"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _model(path).count
        for batch in batches:
            whole = pa.compute.coalesce(batch.column("long"), batch.column("name")).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("name"), batch.column("docs"), pa.array(map(count, whole), pa.int64())], ["name", "docs", "tokens"])

    distinct = texts.mapInArrow(seen, "name binary, long binary, docs bigint").groupBy("name", "long").agg(F.sum("docs").alias("docs"))
    return distinct.mapInArrow(counted, "name binary, docs bigint, tokens bigint")


def _most_common(counted: DataFrame) -> dict[bytes, int]:
    """Tokens of the pre-tokens above the least number of documents, in sixteenths of powers of two,
    that at most HOT reach."""
    level = F.floor(F.log2("docs") * 16)
    sizes = counted.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()  # at most 1,024 rows
    total, least = 0, 1024
    for r in sizes:
        total += r["count"]
        if total > HOT:
            break
        least = r["level"]
    return {bytes(r[0]): r[1] for r in counted.where(level >= least).select("name", "tokens").collect()}


def count(documents: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    Tokens are those of the library at its defaults without begin, end or padding: a text that spells
    an added token has it. A null text is empty and has none. Null and repeated ids and repeated rows
    stay, a row each; other columns are not carried along, and an empty table gives an empty one.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    counted = stored(pieces(rows.select("text"), path), "pieces")
    common = spark.sparkContext.broadcast(_most_common(counted))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = common.value.get
        for some, texts in parts(batches):
            segment, owner, added = segments(texts, _model(path).added)
            known, docs, names, often = added.copy(), [], [], []
            for found, of, piece, n in frequencies(segment):
                name = _named(found)
                tokens = np.fromiter((look_up(x, -1) for x in name), np.int64, len(name))[piece]
                sure = tokens >= 0
                np.add.at(known, owner[of[sure]], n[sure] * tokens[sure])
                docs.append(owner[of[~sure]])
                often.append(n[~sure])
                names += [name[i] for i in piece[~sure].tolist()]
            stops = np.searchsorted(np.concatenate([*docs, np.zeros(0, np.int64)]), np.arange(len(texts) + 1))
            pair = pa.StructArray.from_arrays([pa.array(names, pa.binary()), pa.array(np.concatenate([*often, np.zeros(0, np.int64)]))], ["name", "n"])
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), some.column("n_bytes"), pa.array(known), pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pair)],
                ["doc_id", "n_bytes", "known", "rest"])

    pairs = rows.select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "text").mapInArrow(paired, PAIRS)
    pairs = stored(pairs.withColumn("row", F.monotonically_increasing_id()), "pairs")  # written, so a row keeps its number
    rest = pairs.select("row", F.explode("rest").alias("p")).select("row", "p.name", "p.n")
    left = rest.join(counted.select("name", "tokens"), "name").groupBy(F.col("row").alias("of")).agg(F.sum(F.col("n") * F.col("tokens")).alias("left"))
    n = F.col("known") + F.coalesce("left", F.lit(0))
    return pairs.select("row", "doc_id", "n_bytes", "known").join(left, F.col("row") == F.col("of"), "left").select(
        "doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))

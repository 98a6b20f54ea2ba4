"""Token ids as Parquet list columns, in document order, for selective reads.

Every row holds one document: its id, how many tokens it has, where they begin within the file's
part, and the ids as a list of integers. Ids are dictionary-encoded, counts and offsets
delta-encoded (version 2 pages); row groups and pages have set sizes, and the writer's column and
offset indexes let a reader skip pages by document id and leave the tokens alone when only the
figures are wanted.
"""

from __future__ import annotations

import functools
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from paylake.llm import pretokens
from paylake.llm.batches import parts
from paylake.llm.known import Known
from paylake.llm.workers import ship
from paylake.operators.scratch import new_path

SEPARATOR = "\n"  # no byte is called that
SCHEMA = "doc_id bigint, part int, begin bigint, n_tokens bigint, tokens array<int>"

#: Writer settings: row groups of 32 MB, pages of 64 KB and at most 2,000 documents.
FORMAT = {
    "compression": "snappy", "parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "true",
    "parquet.block.size": str(32 << 20), "parquet.page.size": str(64 << 10), "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
}


class _Library:
    """The tokenizer library's model, asked once for each pre-token."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path, encoding="utf-8") as f:
            shape = json.load(f)
        split = shape["pre_tokenizer"]
        if split["type"] != "ByteLevel" or split["add_prefix_space"] or not split.get("use_regex", True) or shape["normalizer"]:
            raise ValueError("a byte-level tokenizer without prefix space or normalizer is needed")
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = [t["content"] for t in shape["added_tokens"]]
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        names = {}  # what the model calls each byte, as its splitter spells characters of every kind
        for cp in (*range(0x801), *range(0x1000, 0xE000, 0x1000), 0xE000, 0xF000, 0x10000, 0x40000, 0x80000, 0xC0000, 0x100000):
            names.update(zip(chr(cp).encode(), spell.pre_tokenize_str(chr(cp))[0][0]))
        self.names = {i: names.get(i, SEPARATOR) for i in range(256)}  # bytes without a name never occur in UTF-8
        self.known = Known(self.ids)

    def holds_added(self, text: str) -> bool:
        return any(t in text for t in self.added)

    def ids(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pre-tokens, one after the other, and how many each has."""
        spelled = b"\xff".join(pieces).decode("latin-1").translate(self.names).split(SEPARATOR) if pieces else []
        tokenize, flat, count = self.model.tokenize, [], []
        for s in spelled:
            some = tokenize(s)
            flat += [t.id for t in some]
            count.append(len(some))
        return np.array(flat, np.int32), np.array(count, np.intp)


@functools.cache
def _library(path: str) -> _Library:
    return _Library(path)


def _plain(texts: list[str], library: _Library) -> Iterator[bytes]:
    table = pretokens.classes()
    for run in pretokens.groups(texts):
        yield from library.known.ids_of(*pretokens.cuts(run, table))


def encode_texts(texts: list[str], path: str, end_id: int | None, added: bool = False) -> Iterator[bytes]:
    """Id bytes of each text, little-endian 32-bit, with the end id.

    With ``added``, the tokenizer's added tokens have their ids where a text spells one, as in the
    library's default; without, they are ordinary text, as with its ``encode_special_tokens``.
    """
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")
    library = _library(path)
    whole = [added and library.holds_added(t) for t in texts]
    plain = _plain([t for t, w in zip(texts, whole) if not w], library)
    for t, w in zip(texts, whole):
        yield (np.array(library.tokenizer.encode(t, add_special_tokens=False).ids, "<i4").tobytes() if w else next(plain)) + tail


def write(df: DataFrame, folder: str, path: str, end_id: int | None = 2, id_column: str = "doc_id", text: str = "text", added: bool = False) -> None:
    """Encodes every whole text and writes the files in ascending order of the id.

    ``added`` says whether a text may spell the tokenizer's added tokens, see ``encode_texts``.
    A null text counts as empty and yields the end id alone. Rows of equal id follow each other in
    an order fixed by their text; a null id comes first. Other columns are not written, and an
    empty table makes files without rows. The folder must not exist yet.
    """
    ship(df.sparkSession)
    rows = df.select(F.col(id_column).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, begin = TaskContext.get().partitionId(), 0
        for some, texts in parts(batches):
            made = [np.frombuffer(x, "<i4") for x in encode_texts(texts, path, end_id, added)]
            n = np.fromiter(map(len, made), np.int64, len(made))
            stops = np.concatenate([[0], np.cumsum(n)])
            yield pa.RecordBatch.from_arrays(
                [some.column("doc_id"), pa.array(np.full(len(n), part, np.int32)), pa.array(begin + stops[:-1]), pa.array(n),
                 pa.ListArray.from_arrays(pa.array(stops.astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int32), *made])))],
                ["doc_id", "part", "begin", "n_tokens", "tokens"])
            begin += int(stops[-1])

    ordered.mapInArrow(tokens, SCHEMA).write.options(**FORMAT).parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start among all tokens in document order, n_tokens and the ids, from the files.

    Where a part of the files begins is the sum of the parts before it: one small row for each
    writing task, read without the tokens.
    """
    files = spark.read.schema(SCHEMA).parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = parts.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    return files.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("begin")).alias("start"), "n_tokens", "tokens")


def crc32_of_ids(ids: Column) -> Column:
    """Unsigned crc32 of a list of ids as little-endian 32-bit integers; null for a null list."""

    @F.arrow_udf("bigint")
    def udf(column: pa.Array) -> pa.Array:
        flat = memoryview(column.values.to_numpy(zero_copy_only=False).astype("<i4")).cast("B")
        at = column.offsets.to_pylist()
        valid = column.is_valid().to_pylist()
        return pa.array([zlib.crc32(flat[4 * a:4 * b]) if v else None for a, b, v in zip(at, at[1:], valid)], pa.int64())

    return udf(ids)


def written_and_read(spark: SparkSession, documents: DataFrame, path: str, added: bool = False) -> DataFrame:
    """Writes all documents in a fresh shared folder and returns each one's figures from the files."""
    folder = new_path(spark, "tokens")
    write(documents, folder, path, added=added)
    return read(spark, folder).select("doc_id", "start", F.size("tokens").cast("bigint").alias("n_tokens"), crc32_of_ids(F.col("tokens")).alias("ids_crc32"))

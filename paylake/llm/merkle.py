"""Merkle manifest of a table: one tree of digests for each group of rows, and one over the groups.

Of a tree only every second level is stored (``EVERY``), in blocks: a stored row holds the digests
of one aligned subtree, at most 64 (``FANOUT ** EVERY``) in order. The levels between are made
again from those where a proof needs them, used, and dropped. A node's path, the siblings on every
level up to the root, is known from the top down: the path of the stored node above its block, and
before it the siblings inside the block. So the upper path is joined once for each block, and
only figures of documents leave the lowest blocks.

Places of leaves come from a range partitioning and the number of rows of a group in each part, so
a large group is spread over tasks; no window holds a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.llm.exact import LOWER, UPPER
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

FANOUT = 8
EVERY = 2  # levels from one that is stored to the next
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
AT_A_TIME = 64  # blocks that a worker turns into Python values


def digest(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the columns' texts one after the other."""
    return F.sha2(F.concat(*columns), 256)


def field(c: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its length in bytes, a colon and itself."""
    value = c.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value))


def leaves(documents: DataFrame) -> DataFrame:
    """doc_id, lang, leaf and ``tampered``: the leaf after the text's A-Z were lower-cased, for the
    rows whose id has a crc32 that 3 divides, else null. A column that a table lacks is null."""
    kinds = {"doc_id": "bigint", "n_chars": "bigint"}
    known = [(F.col(c) if c in documents.columns else F.lit(None)).cast(kinds.get(c, "string")).alias(c) for c in COLUMNS]
    rest = [field(F.col(c)) for c in COLUMNS[:-1]]
    touched = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 0
    return documents.select(*known).select(
        "doc_id", "lang", digest(*rest, field(F.col("text"))).alias("leaf"),
        F.when(touched, digest(*rest, field(F.translate("text", UPPER, LOWER)))).alias("tampered"))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Adds ``at``, the place of a row in its group by ``order``, nulls first, and ``size``, the group's rows.

    The rows are sorted into ranges and written, which fixes their numbers. What lies before a range
    comes from one small row for each range and group that meet: as many as ranges and groups.
    """
    by = [F.col(c).asc_nulls_first() for c in (group, *order)]
    number = F.monotonically_increasing_id()  # range in the upper bits, place in the range in the lower
    sorted_ = stored(rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumns({"_row": number, "_range": F.spark_partition_id()}), "sorted")
    met = sorted_.groupBy(F.col(group).alias("_group"), F.col("_range").alias("_of")).agg(F.count("*").alias("n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy("_group")
    before = F.coalesce(F.sum("n").over(whole.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = met.select("_group", "_of", "_first", before.alias("_before"), F.sum("n").over(whole).alias("size"))
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of"))
    return sorted_.join(bases, same).select(*rows.columns, (F.col("_before") + F.col("_row") - F.col("_first")).alias("at"), "size")


def blocks(rows: DataFrame, group: str, what: list[str], every: int) -> DataFrame:
    """The rows of a placed level as ``nodes``, a sorted list for each aligned subtree.

    ``size`` stays the number of nodes of the group on this level.
    """
    at = F.expr(f"at div {FANOUT**every}")
    return rows.groupBy(group, "size", at.alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", *what))).alias("nodes"))


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def above(nodes: list[str]) -> list[str]:
    """The level above an aligned list of digests."""
    return [_sha("".join(nodes[i:i + FANOUT])) for i in range(0, len(nodes), FANOUT)]


def inner_levels(nodes: list[str], size: int, every: int) -> list[list[str]]:
    """A block's digests and those of the levels that are not stored, up to the one the next stored
    level begins with. ``size``: nodes of the whole tree on the block's level; one node is its root."""
    out = [nodes]
    for _ in range(every):
        if size <= 1:
            break
        out.append(above(out[-1]))
        size = -(-size // FANOUT)
    return out


def siblings(levels: list[list[str]], i: int) -> list[str]:
    """What stands before and after node ``i`` in its run, level by level below the last."""
    out = []
    for nodes in levels[:-1]:
        first = i - i % FANOUT
        out += ["".join(nodes[first:i]), "".join(nodes[i + 1:first + FANOUT])]
        i //= FANOUT
    return out


def fold(node: str, path: list[str]) -> str:
    """The root that a digest and the siblings on its path give."""
    for left, right in zip(path[::2], path[1::2]):
        node = _sha(left + node + right)
    return node


def _by_block(rows: DataFrame, of_block: Callable[[dict], Iterator[tuple]], schema: str) -> DataFrame:
    """Rows that a function gives for each block, a few blocks at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [_ARROW[c.split()[1]] for c in schema.split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, AT_A_TIME):
                made = [r for block in batch.slice(at, AT_A_TIME).to_pylist() for r in of_block(block)]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in made], t) for i, t in enumerate(types)], names)

    return rows.mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "array<string>": pa.list_(pa.string())}


def _risen(level: DataFrame, group: str, every: int) -> DataFrame:
    """The next stored level of a table of blocks: group, at, size and node."""
    def of_block(b: dict) -> Iterator[tuple]:
        yield b[group], b["block"], -(-b["size"] // FANOUT**every), inner_levels([x["node"] for x in b["nodes"]], b["size"], every)[-1][0]

    return _by_block(level, of_block, f"{group} {dict(level.dtypes)[group]}, at bigint, size bigint, node string")


def tree(rows: DataFrame, group: str, what: list[str], every: int = EVERY) -> list[DataFrame]:
    """Stored levels of the trees of a placed table with ``node``, the lowest first.

    The last one has one block of one node for each group, its root. ``what`` else the lowest level keeps.
    """
    levels = [stored(blocks(rows, group, ["node", *what], every), "level")]
    while not levels[-1].where("size > 1").isEmpty():
        levels.append(stored(blocks(_risen(levels[-1], group, every), group, ["node"], every), "level"))
    return levels


def _under(level: DataFrame, upper: DataFrame, group: str) -> DataFrame:
    """A level's blocks with the root and the path of the node above each block."""
    above_ = upper.select(F.col(group).alias("_group"), F.col("at").alias("_at"), "root", "path")
    return level.join(above_, F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_at"))).drop("_group", "_at")


def _paths(block: dict, every: int) -> Iterator[tuple[dict, list[str]]]:
    """The nodes of a block with their siblings up to the root."""
    levels = inner_levels([x["node"] for x in block["nodes"]], block["size"], every)
    for i, x in enumerate(block["nodes"]):
        yield x, siblings(levels, i) + block["path"]


def upper_paths(levels: list[DataFrame], group: str, top: DataFrame, every: int = EVERY) -> DataFrame:
    """group, at, root and path of the nodes that stand above the lowest blocks, from the top down.

    ``top`` has them for the groups' own roots, so that a tree of trees goes on.
    """
    upper, schema = top, f"{group} {dict(top.dtypes)[group]}, at bigint, root string, path array<string>"
    for level in reversed(levels[1:]):
        upper = stored(_by_block(_under(level, upper, group), lambda b: ((b[group], x["at"], b["root"], path) for x, path in _paths(b, every)), schema), "paths")
    return upper


def manifest(documents: DataFrame, every: int = EVERY) -> DataFrame:
    """leaf, subroot, root, proof_sha256, folded_root and verified of every document.

    Nulls enter a leaf as ``-``; documents without a language are a group of their own, the first.
    Null ids come first, and rows of one id follow each other by their leaf, so repeated rows, which
    have one leaf, take neighbouring places. Other columns do not count, and an empty table gives an
    empty one.
    """
    ship(documents.sparkSession)
    listed = stored(leaves(documents).withColumnRenamed("leaf", "node"), "leaves")
    trees = tree(placed(listed, "lang", ["doc_id", "node"]), "lang", ["doc_id", "tampered"], every)
    subroots = stored(trees[-1].select("lang", F.element_at("nodes", 1)["node"].alias("node"), F.lit(0).cast("bigint").alias("whole")), "subroots")

    forest = tree(placed(subroots, "whole", ["lang"]), "whole", ["lang"], every)
    root = forest[-1].select("whole", F.lit(0).cast("bigint").alias("at"), F.element_at("nodes", 1)["node"].alias("root"), F.array().cast("array<string>").alias("path"))
    upper = upper_paths(forest, "whole", root, every)
    # The subroot rides with the root, as one text, so that a lowest block finds both by one join.
    tops = stored(_by_block(
        _under(forest[0], upper, "whole"), lambda b: ((x["lang"], 0, x["node"] + b["root"], path) for x, path in _paths(b, every)),
        "lang string, at bigint, root string, path array<string>"), "tops")

    def proved(b: dict) -> Iterator[tuple]:
        subroot, root = b["root"][:64], b["root"][64:]
        for x, path in _paths(b, every):
            yield x["doc_id"], x["node"], subroot, root, _sha("".join(path)), fold(x["tampered"] or x["node"], path)

    found = _by_block(_under(trees[0], upper_paths(trees, "lang", tops, every), "lang"), proved,
                      "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))

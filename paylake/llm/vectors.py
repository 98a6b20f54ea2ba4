"""Near duplicates among embeddings by a flat graph built on overlapping cluster shards.

Vectors of one label fall into clusters, large clusters into smaller ones, and each vector goes to
its two nearest, so shards overlap and have a bounded size. In each shard a vector keeps a few
neighbours in different directions (robust pruning); the lists of a vector from all its shards are
united. Every vector is then searched for, in each of its shards: a greedy walk with a beam from the
medoid to its surroundings, then along every edge from what lies within the range. What is found
is compared exactly.

Division would part what links with nearly everything around it. While a large cluster is divided,
balls of the threshold's radius that hold many of its vectors are taken out. What lies in a ball is
compared, in pairs of blocks, with all that the triangle inequality allows it to link with: its links
are counted exactly, and only those that connect are kept. An audit by brute force over queries,
drawn until enough of them have links, measures the recall of the rest; a label it finds too low
is compared exactly, in pairs of blocks, as a whole.
"""

from __future__ import annotations

import functools
import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, Window, functions as F

from paylake.llm.components import components
from paylake.llm.workers import ship
from paylake.operators.scratch import stored

SHARD = 1_000  # vectors of a shard; a larger cluster is divided
CHILDREN = 16  # clusters that a larger one is divided into at most
SAMPLE = 512  # vectors of a cluster that its parts' centres are fitted on
DEPTH = 8  # divisions, after which what is still too large is dealt out as pairs of blocks
SALT = 20_000  # vectors of a cluster that one task assigns
OVERLAP = 2  # nearest clusters that a vector goes to
NEAREST = 40  # candidates for a vector's neighbours in a shard
DEGREE = 20  # neighbours after pruning
ALPHA = 1.2
BEAM = 24
SLACK = 0.06  # how far below the threshold the range search still goes on
AUDIT = 200  # queries that the audit begins with
LINKED = 50  # queries with links that the audit wants to see
MOST = 12_800  # queries that the audit ends with, if it sees fewer
ENOUGH = 20  # links of a label from which its own recall counts
RECALL = 0.95
BALL = 8  # sampled vectors that a ball holds at least
BLOCKS = 32  # blocks of at most SHARD vectors; where more are needed they grow to 8 * SHARD first
CHUNK = 256

log = logging.getLogger(__name__)


def units(vectors: list) -> np.ndarray:
    """Vectors of length 1 in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _centres(x: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means, begun with vectors far from each other."""
    picked = [0]
    near = x @ x[0]
    while len(picked) < min(k, len(x)):
        picked.append(int(near.argmin()))
        near = np.maximum(near, x @ x[picked[-1]])
    c = x[picked]
    for _ in range(8):
        own = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        size = np.sqrt((sums * sums).sum(1, keepdims=True))
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def _reach(least: float) -> float:
    """Cosine with a ball's centre of whatever links with a vector in it: twice the angle, and rounding."""
    return (2 * least * least - 1 if least > 0 else -1.0) - 1e-9


def balls(x: np.ndarray, least: float, need: float) -> np.ndarray:
    """Centres of balls of the threshold's radius that hold ``need`` vectors or more, those with most first."""
    c = (x @ x.T >= _reach(least)).astype(float) @ x
    c /= np.maximum(np.sqrt((c * c).sum(1, keepdims=True)), 1e-9)
    holds = (c @ x.T >= least).astype(float)
    chosen, left = [], np.ones(len(x))
    while True:
        n = holds @ left
        best = int(n.argmax())
        if n[best] < need:
            return c[chosen]
        chosen.append(best)
        left[holds[best] > 0] = 0


def _fit(least: float | None, many: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("node")
        x = units(group["embedding"])
        c = _centres(x, int(group["parts"].iloc[0]))
        dense = c[:0] if least is None else balls(x, least, max(BALL, len(x) * many / group["size"].iloc[0]))
        return pd.DataFrame({"shard": [group["shard"].iloc[0]], "class": [group["class"].iloc[0]], "centres": [c.ravel()], "balls": [dense.ravel()]})

    return run


def _class() -> Column:
    return F.xxhash64("label", F.size("embedding"))


def _assign(overlap: int, least: float | None):
    """Members follow their cluster's centres in sorted rows; each goes to its nearest parts, unless a ball holds it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centres, dense = None, None, None
        for batch in batches:
            shards = batch.column("shard").to_numpy()
            edges = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            for a, b in zip(edges, edges[1:]):
                some = batch.slice(a, b - a)
                heads = some.filter(pa.compute.equal(some.column("kind"), 0))
                if len(heads):
                    now, centres, dense = shards[a], np.asarray(heads.column("centres")[0].as_py()), np.asarray(heads.column("balls")[0].as_py(), float)
                rows = some.filter(pa.compute.equal(some.column("kind"), 1))
                if not len(rows):
                    continue
                assert now == shards[a]
                nodes = rows.column("node").to_numpy()
                x = units(rows.column("embedding").to_pylist())
                if len(dense):
                    out = (x @ dense.reshape(-1, x.shape[1]).T).max(1) < least + 1e-9
                    nodes, x = nodes[out], x[out]
                near = x @ centres.reshape(-1, x.shape[1]).T
                k = min(overlap, near.shape[1])
                part = np.argsort(-near, 1, kind="stable")[:, :k]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(nodes, k)), pa.array(np.full(part.size, shards[a])), pa.array(part.ravel())],
                    ["node", "parent", "part"])

    return run


def shards(classes: DataFrame, overlap: int, least: float | None = None, found: list[DataFrame] | None = None) -> DataFrame:
    """node, shard: every vector's shards, none of them above SHARD vectors.

    With ``least``, the balls met (class, balls) are added to ``found``, and what they hold is not divided further.
    """
    inside = stored(classes.select("node", _class().alias("shard")), "shards")
    done = None
    for _ in range(DEPTH):
        size = inside.groupBy("shard").agg(F.count("*").alias("size"))
        large = stored(size.where(F.col("size") > SHARD), "large")
        if large.isEmpty():
            break
        large = large.select(F.col("shard").alias("s"), "size", F.least(F.lit(CHILDREN), F.ceil(F.col("size") * overlap / SHARD)).cast("int").alias("parts"), F.ceil(F.col("size") / SALT).alias("salts"))
        small = inside.join(large, F.col("shard") == F.col("s"), "left_anti")
        done = small if done is None else done.union(small)
        rest = inside.join(large, F.col("shard") == F.col("s")).join(classes.select(F.col("node").alias("n"), "embedding", _class().alias("class")), F.col("node") == F.col("n"))
        rest = stored(rest.select("node", "shard", "class", "size", "parts", "salts", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), "embedding"), "rest")
        nth = F.row_number().over(Window.partitionBy("shard").orderBy(F.xxhash64("node", "shard"), "node"))
        sample = rest.withColumn("nth", nth).where(F.col("nth") <= SAMPLE).select("shard", "class", "size", "node", "embedding", "parts")
        fitted = sample.groupBy("shard").applyInPandas(_fit(least, SHARD // 2), "shard bigint, class bigint, centres array<double>, balls array<double>")
        centres = stored(fitted, "centres")
        if found is not None:
            found.append(centres.where(F.size("balls") > 0).select("class", "balls"))
        heads = centres.join(large, F.col("shard") == F.col("s")).select("shard", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("node"), F.lit(None).cast(rest.schema["embedding"].dataType).alias("embedding"), "centres", "balls")
        members = rest.select("shard", "salt", F.lit(1).alias("kind"), "node", "embedding", F.lit(None).cast("array<double>").alias("centres"), F.lit(None).cast("array<double>").alias("balls"))
        rows = heads.unionByName(members).repartition("shard", "salt").sortWithinPartitions("shard", "salt", "kind")
        dealt = rows.drop("salt").mapInArrow(_assign(overlap, least), "node bigint, parent bigint, part bigint")
        inside = stored(dealt.select("node", F.xxhash64("parent", "part").alias("shard")).distinct(), "shards")
    size = inside.groupBy(F.col("shard").alias("s")).agg(F.count("*").alias("size"))
    blocks = F.ceil(F.col("size") * 2 / SHARD)
    dealt = (
        inside.join(size, F.col("shard") == F.col("s")).withColumn("blocks", F.when(F.col("size") > SHARD, blocks).otherwise(1))
        .withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")))
        .withColumn("other", F.explode(F.expr("case when blocks = 1 then array(0L) else filter(sequence(0L, blocks - 1), x -> x <> mine) end"))))
    last = dealt.select("node", F.when(F.col("blocks") == 1, F.col("shard")).otherwise(F.xxhash64("shard", F.least("mine", "other"), F.greatest("mine", "other"))).alias("shard"))
    return last if done is None else done.select("node", "shard").union(last)


def prune(x: np.ndarray) -> list[np.ndarray]:
    """Neighbours of every vector of a shard: the nearest, but none that a nearer one stands for."""
    m = len(x)
    k = min(NEAREST, m - 1)
    if k <= 0:
        return [np.zeros(0, np.int64)] * m
    candidates, far = np.empty((m, k), np.int64), np.empty((m, k))
    for a in range(0, m, CHUNK):
        d = 1 - x[a:a + CHUNK] @ x.T
        d[np.arange(len(d)), np.arange(a, a + len(d))] = np.inf
        some = np.argpartition(d, k - 1, 1)[:, :k]
        order = np.argsort(np.take_along_axis(d, some, 1), 1, kind="stable")
        candidates[a:a + CHUNK] = np.take_along_axis(some, order, 1)
        far[a:a + CHUNK] = np.take_along_axis(d, candidates[a:a + CHUNK], 1)
    edges: list[list[int]] = [[] for _ in range(m)]
    for a in range(0, m, CHUNK):
        c, d = candidates[a:a + CHUNK], far[a:a + CHUNK]
        open_ = np.ones(c.shape, bool)
        rows = np.arange(len(c))
        vectors = x[c]
        for _ in range(min(DEGREE, k)):
            pick = open_.argmax(1)
            some = open_[rows, pick]
            if not some.any():
                break
            for r in rows[some].tolist():
                edges[a + r].append(int(c[r, pick[r]]))
            between = 1 - np.einsum("qkd,qd->qk", vectors, vectors[rows, pick])
            open_ &= ~(ALPHA * between <= d) | ~some[:, None]
            open_[rows, pick] = False
    # an edge back, so that every vector can be walked to, and a chain of nearest vectors from the medoid
    for i, out in enumerate([list(e) for e in edges]):
        for j in out[:4]:
            edges[j].append(i)
    return [np.unique(np.array(e, np.int64)) for e in edges]


def _build(group: pd.DataFrame) -> pd.DataFrame:
    nodes = group["node"].to_numpy()
    lists = prune(units(group["embedding"]))
    return pd.DataFrame({"node": nodes, "near": [nodes[e] for e in lists]})


def search(x: np.ndarray, lists: list[np.ndarray], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of vectors at least that similar, by greedy walks from the medoid and range expansion."""
    m = len(x)
    if m < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = max(1, max(map(len, lists)))
    near = np.full((m, width), -1)
    for i, e in enumerate(lists):
        near[i, :len(e)] = e
    medoid = int((x @ x.sum(0)).argmax())
    found = []
    for a in range(0, m, CHUNK):
        q = x[a:a + CHUNK]
        n = len(q)
        rows = np.arange(n)
        like = np.full((n, m), -np.inf)
        todo = np.zeros((n, m), bool)
        like[:, medoid] = q @ x[medoid]
        todo[:, medoid] = True

        def expand(r: np.ndarray, c: np.ndarray) -> None:
            todo[r, c] = False
            r, c = np.repeat(r, width), near[c].ravel()
            some = c >= 0
            key = np.unique(r[some] * m + c[some])
            r, c = key // m, key % m
            new = like[r, c] == -np.inf
            r, c = r[new], c[new]
            for i in range(0, len(r), 1 << 16):
                s = slice(i, i + (1 << 16))
                like[r[s], c[s]] = np.einsum("pd,pd->p", q[r[s]], x[c[s]])
            todo[r, c] = True

        while True:  # the beam: the nearest vectors met are all expanded
            score = np.where(todo, like, -np.inf)
            best = score.argmax(1)
            top = score[rows, best]
            last = np.partition(like, m - BEAM, 1)[:, m - BEAM] if m > BEAM else np.full(n, -np.inf)
            go = (top > -np.inf) & (top >= last)
            if not go.any():
                break
            expand(rows[go], best[go])
        while True:  # the range
            r, c = np.nonzero(todo & (like >= least - SLACK))
            if not len(r):
                break
            expand(r, c)
        r, c = np.nonzero(like >= least)
        found.append(np.stack([r + a, c]))
    pairs = np.concatenate(found, 1)
    pairs = np.unique(np.sort(pairs[:, pairs[0] != pairs[1]], 0), axis=1)
    return pairs[0], pairs[1]


def _find(least: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        nodes = group["node"].to_numpy()
        order = np.argsort(nodes, kind="stable")
        known = nodes[order]
        lists = []
        for e in group["near"]:
            e = np.asarray(e, np.int64)
            at = np.minimum(np.searchsorted(known, e), len(known) - 1)
            lists.append(np.unique(order[at[known[at] == e]]))
        a, b = search(units(group["embedding"]), lists, least)
        return pd.DataFrame({"a": np.minimum(nodes[a], nodes[b]), "b": np.maximum(nodes[a], nodes[b])})

    return run


def _near(least: float):
    """Balls of each member, in sorted rows behind its class's centres: the one that holds it (0), those it may link into (1, or 2 if one holds it)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, centres = None, None
        for batch in batches:
            of = batch.column("class").to_numpy()
            edges = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for a, b in zip(edges, edges[1:]):
                some = batch.slice(a, b - a)
                heads = some.filter(pa.compute.equal(some.column("kind"), 0))
                if len(heads):
                    now, centres = of[a], np.asarray(heads.column("centres")[0].as_py())
                rows = some.filter(pa.compute.equal(some.column("kind"), 1))
                if not len(rows):
                    continue
                assert now == of[a]
                x = units(rows.column("embedding").to_pylist())
                like = x @ centres.reshape(-1, x.shape[1]).T
                best = like.argmax(1)
                held = like[np.arange(len(x)), best] >= least
                i, ball = np.nonzero(like >= _reach(least))
                kind = np.where(held[i], np.where(ball == best[i], 0, 2), 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows.column("node").to_numpy()[i]), pa.array(np.full(len(i), of[a])), pa.array(ball), pa.array(kind)], ["node", "class", "ball", "kind"])

    return run


def held(classes: DataFrame, found: list[DataFrame], least: float) -> DataFrame | None:
    """node, unit, kind: the balls around every vector; None if there are no balls."""
    met = functools.reduce(DataFrame.union, found) if found else None
    if met is None or met.isEmpty():
        return None
    size = classes.groupBy(_class().alias("c")).agg(F.ceil(F.count("*") / SALT).alias("salts"))
    met = met.groupBy("class").agg(F.flatten(F.collect_list("balls")).alias("centres"))
    heads = stored(met.join(size, F.col("class") == F.col("c")).select("class", "salts", "centres"), "balls")
    rows = classes.select("node", _class().alias("c"), "embedding").join(heads.select("class", "salts"), F.col("c") == F.col("class"))
    members = rows.select("class", F.pmod(F.xxhash64("node"), F.col("salts")).alias("salt"), F.lit(1).alias("kind"), "node", "embedding", F.lit(None).cast("array<double>").alias("centres"))
    first = heads.select("class", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("node"), F.lit(None).cast(classes.schema["embedding"].dataType).alias("embedding"), "centres")
    dealt = first.unionByName(members).repartition("class", "salt").sortWithinPartitions("class", "salt", "kind")
    near = dealt.drop("salt").mapInArrow(_near(least), "node bigint, class bigint, ball bigint, kind bigint")
    return stored(near.select("node", F.xxhash64("class", "ball").alias("unit"), "kind"), "held")


def count_links(x: np.ndarray, left: np.ndarray, right: np.ndarray, kind: np.ndarray, copies: np.ndarray, least: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links of each vector between two blocks, or inside one, and some links that connect all that link.

    Vectors of kind 0 count all their links, of kind 1 those with kind 0, of kind 2 none.
    """
    same, n, edges = left is right, np.zeros(len(x)), []
    root, own = np.arange(len(x)), copies * (kind == 0)

    def counted(i: np.ndarray, links: np.ndarray, j: np.ndarray) -> np.ndarray:
        both = links @ np.stack([copies[j], own[j]], 1)
        return np.where(kind[i] == 0, both[:, 0], np.where(kind[i] == 1, both[:, 1], 0))

    for a in range(0, len(left), CHUNK):
        some = left[a:a + CHUNK]
        like = x[some] @ x[right].T >= least
        if same:
            like[np.arange(len(some)), np.arange(a, a + len(some))] = False
        links = like.astype(float)
        n[some] += counted(some, links, right)
        if not same:
            n[right] += counted(right, links.T, some)
        for r in np.flatnonzero((like & (root[right] != root[some][:, None])).any(1)).tolist():
            to = right[like[r]]
            names, first = np.unique(root[to], return_index=True)
            new = names != root[some[r]]
            if new.any():
                edges += [(int(some[r]), j) for j in to[first[new]].tolist()]
                root[np.isin(root, names[new])] = root[some[r]]
    return n, edges


def _blocks(least: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        nodes, block = group["node"].to_numpy(), group["mine"].to_numpy()
        left = np.flatnonzero(block == group["lo"].iloc[0])
        right = left if group["lo"].iloc[0] == group["hi"].iloc[0] else np.flatnonzero(block == group["hi"].iloc[0])
        n, edges = count_links(units(group["embedding"]), left, right, group["kind"].to_numpy(), group["copies"].to_numpy().astype(float), least)
        some = np.flatnonzero(n)
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        return pd.DataFrame({
            "node": np.concatenate([nodes[some], nodes[a]]), "n": np.concatenate([n[some].astype(np.int64), np.zeros(len(a), np.int64)]),
            "to": pd.array([*[None] * len(some), *nodes[b].tolist()], "Int64")})

    return run


def exact_links(classes: DataFrame, of: DataFrame, least: float) -> DataFrame:
    """node, n, to: how many links a vector has in pairs of blocks of its units, and links that connect (to)."""
    size = of.groupBy(F.col("unit").alias("u")).agg(F.count("*").alias("size"))
    blocks = size.select("u", F.greatest(F.least(F.ceil(F.col("size") / SHARD), F.lit(BLOCKS)), F.ceil(F.col("size") / (8 * SHARD))).alias("blocks"))
    dealt = (
        of.join(blocks, F.col("unit") == F.col("u")).withColumn("mine", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select("node", "unit", "kind", "mine", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi")))
    filled = dealt.join(classes.select(F.col("node").alias("m"), "copies", "embedding"), F.col("node") == F.col("m")).drop("m")
    return stored(filled.groupBy("unit", "lo", "hi").applyInPandas(_blocks(least), "node bigint, n bigint, to bigint"), "exact")


def _links(classes: DataFrame, least: float, overlap: int, placed: DataFrame | None = None) -> DataFrame:
    vectors = classes.select(F.col("node").alias("n"), "embedding")
    placed = stored(shards(classes, overlap).distinct(), "placed") if placed is None else placed
    filled = placed.join(vectors, F.col("node") == F.col("n")).select("shard", "node", "embedding")
    lists = filled.groupBy("shard").applyInPandas(_build, "node bigint, near array<bigint>")
    union = lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    whole = placed.join(union, "node").join(vectors, F.col("node") == F.col("n")).select("shard", "node", "near", "embedding")
    return stored(whole.groupBy("shard").applyInPandas(_find(least), "a bigint, b bigint").distinct(), "pairs")


def _brute(classes: DataFrame, least: float, count: int) -> tuple[DataFrame, bool]:
    """Links (q, class, a, b) of ``count`` vectors, classes taking turns, by brute force; whether these were all."""
    order = [F.xxhash64("node", F.lit(1)), F.col("node")]
    ranked = classes.select("node", "embedding", _class().alias("class"))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("class").orderBy(*order))).where(F.col("rank") <= count)
    some = ranked.orderBy("rank", *order).limit(count).toPandas()
    queries = {key: (g["node"].to_numpy(), units(g["embedding"])) for key, g in some.groupby("class")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            for key, g in rows.groupby("class") if len(rows) else ():
                if key not in queries:
                    continue
                (nodes, x), other = queries[key], g["node"].to_numpy()
                i, j = np.nonzero(x @ units(g["embedding"]).T >= least)
                q, o = nodes[i], other[j]
                q, o = q[q != o], o[q != o]
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(np.full(len(q), key)), pa.array(np.minimum(q, o)), pa.array(np.maximum(q, o))], ["q", "class", "a", "b"])

    true = classes.select("node", _class().alias("class"), "embedding").mapInArrow(run, "q bigint, class bigint, a bigint, b bigint")
    return stored(true, "true"), len(some) < count


def _audit(classes: DataFrame, pairs: DataFrame, least: float) -> dict[int, tuple[int, int]]:
    """Of the vectors drawn: links of each class, and how many of them the search found.

    More vectors are drawn until LINKED of them have links, all are drawn, or MOST are.
    """
    count = AUDIT
    while True:
        true, ended = _brute(classes, least, count)
        if ended or count >= MOST or true.select("q").distinct().count() >= LINKED:
            break
        count *= 4
    hits = true.select("class", "a", "b").distinct().join(pairs.select("a", "b").withColumn("hit", F.lit(1)), ["a", "b"], "left")
    return {r[0]: (r[1], r[2]) for r in hits.groupBy("class").agg(F.count("*"), F.count("hit")).collect()}


def _share(audit: dict[int, tuple[int, int]]) -> float:
    """Recall over all classes; not a number where no link was seen, which measures nothing."""
    n = sum(a for a, _ in audit.values())
    return sum(h for _, h in audit.values()) / n if n else float("nan")


def _audited(classes: DataFrame, pairs: DataFrame, least: float) -> float:
    return _share(_audit(classes, pairs, least))


def _missed(audit: dict[int, tuple[int, int]]) -> list[int]:
    """Classes whose recall is too low, by few links only where that of all is."""
    low = _share(audit) < RECALL
    return [c for c, (n, hit) in audit.items() if hit < RECALL * n and (low or n >= ENOUGH)]


def near_duplicates(embeddings: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector.

    Vectors of one label and length link at a cosine of ``least`` or more. Null labels and vectors,
    empty and zero ones, and those with a null or non-finite component link with nothing. Equal
    vectors are one node of the graph, which stands for all of them; they link with each other.
    Rows of one vec_id are one vector of the components but counted singly as links; a null vec_id
    has no links. Other columns are not carried along, and an empty table gives an empty one.
    """
    ship(embeddings.sparkSession)
    e = F.col("embedding")
    fine = F.coalesce(
        F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(e, lambda v: v != 0), F.lit(False))
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding")
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine)
    classes = stored(usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")), "classes")
    # two rows of one id may hold different vectors: a node needs a number of its own
    taken = F.row_number().over(Window.partitionBy("node").orderBy("label", "embedding"))
    single = stored(classes.withColumn("nth", taken), "classes")
    extra = single.where("nth > 1")
    classes = single.where("nth = 1").drop("nth") if extra.isEmpty() else single.select(
        "label", "embedding", F.when(F.col("nth") == 1, F.col("node")).otherwise(F.xxhash64("node", "label", "embedding")).alias("node"), "copies", F.col("node").alias("vec_id"))
    found: list[DataFrame] = []
    placed = stored(shards(classes, OVERLAP, least, found).distinct(), "placed")
    around = held(classes, found, least)
    loose = classes if around is None else stored(classes.join(around.where("kind = 0").select("node"), "node", "left_anti"), "loose")
    pairs = _links(loose, least, OVERLAP, placed)
    audit = _audit(loose, pairs, least)
    missed = _missed(audit)
    log.info("recall of the audit %s, %d labels compared exactly", f"{_share(audit):.4f}" if audit else "not measured: no link seen", len(missed))
    if missed:
        whole = loose.where(_class().isin(missed)).select("node", _class().alias("unit"), F.lit(0).cast("bigint").alias("kind"))
        pairs = pairs.join(whole.select(F.col("node").alias("a")), "a", "left_anti").select("a", "b")
        around = whole if around is None else around.unionByName(whole)
    counted = None if around is None else exact_links(classes, around, least)
    ends = pairs.select(F.col("a").alias("from"), F.col("b").alias("to")).union(pairs.select("b", "a"))
    copies = classes.select(F.col("node").alias("n"), "copies")
    degree = ends.join(copies, F.col("to") == F.col("n")).select("from", "copies")
    if counted is not None:
        degree = degree.union(counted.where("to is null").select("node", "n"))
        pairs = pairs.union(counted.where("to is not null").select("node", "to"))
    degree = degree.groupBy("from").agg(F.sum("copies").alias("others"))
    named = F.col("vec_id") if "vec_id" in classes.columns else F.col("node")
    of = classes.select("label", "embedding", "node", "copies", named.alias("first"))
    joined = stored(usable.join(of, ["label", "embedding"]).select("vec_id", "node", "first", "copies"), "joined")
    names = of.select(F.col("node").alias("n"), F.col("first").alias("name"))
    same = joined.where("vec_id <> first").select(F.col("vec_id").alias("a"), F.col("first").alias("b"))
    between = pairs.join(names, F.col("a") == F.col("n")).select("b", F.col("name").alias("x")).join(names, F.col("b") == F.col("n")).select(F.col("x").alias("a"), F.col("name").alias("b"))
    reached = components(same.union(between)).select(F.col("node").alias("v"), "component")
    linked = joined.join(degree, F.col("node") == F.col("from"), "left").join(reached, F.col("vec_id") == F.col("v"), "left").select(
        "vec_id", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    rest = rows.where(~(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine)).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

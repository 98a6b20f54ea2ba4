"""Exact and near duplicates of texts, near duplicates of vectors and components by brute force."""

import collections
import random
import re

import numpy as np
import pytest

from paylake.llm import components, exact, jaccard, shingles, vectors
from paylake.llm.prefix_tree import PrefixTree

LOWER = {i: i + 32 for i in range(65, 91)}


def grouped(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def grams(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def similar(sets, percent):
    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                yield a, b


def near_copies(seed, n=120):
    """Texts with copies that differ in some words, in chains, and a passage that many share."""
    rnd, made = random.Random(seed), []
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    for _ in range(n):
        if made and rnd.random() < 0.6:
            text = list(rnd.choice(made))
            for _ in range(rnd.choice([0, 1, 1, 2, 5])):
                text[rnd.randrange(len(text))] = rnd.choice(vocabulary)
        else:
            text = [rnd.choice(vocabulary) for _ in range(rnd.choice([1, 3, 5, 12, 40, 90, 200]))]
            if rnd.random() < 0.4:
                text += passage
        made.append(text)
    return [" ".join(t) for t in made]


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 60)])
def test_near_duplicates(spark, words, percent):
    texts = near_copies(words) + [None, "", " "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    sets = {i: grams(t, words) for i, t in enumerate(texts)}
    want = grouped(similar(sets, percent), sets)
    got = {r[0]: (r[1], r[2]) for r in jaccard.near_duplicates(df, jaccard.Similarity(words, percent)).collect()}
    assert got == {i: (len(s), want[i]) for i, s in sets.items()}
    assert any(want[i] != i for i in want)


def test_large_clusters_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    test_near_duplicates(spark, 4, 85)


@pytest.mark.parametrize("common", [1, 2, 10])
def test_common_paths(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "COMMON", common)
    test_near_duplicates(spark, 4, 85)


def test_near_duplicates_of_odd_rows(odd):
    got = jaccard.near_duplicates(odd, jaccard.Similarity(4, 85)).collect()
    assert len(got) == odd.count()
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_shingles, r.component_id))
    assert by_id[None] == {(2, None)} and by_id[0] == {(0, 0)} and by_id[3] == {(1, 3)} and by_id[4] == {(1, -7)}


@pytest.mark.parametrize("seed", range(4))
def test_prefix_tree(seed):
    rnd, tree, sets = random.Random(seed), PrefixTree(80), []
    for _ in range(150):
        base = set(rnd.choice(sets)) if sets and rnd.random() < 0.7 else {rnd.randrange(10**6) for _ in range(rnd.choice([1, 6, 30, 200]))}
        for _ in range(rnd.choice([0, 0, 1, 3, 12])):
            base.discard(rnd.choice(sorted(base))) if rnd.random() < 0.5 and len(base) > 1 else base.add(rnd.randrange(10**6))
        sets.append(base)
    links = [(i, j) for i, s in enumerate(sets) for j in tree.add(np.array(sorted(s), np.uint64))]
    known = dict(enumerate(sets))
    assert all(100 * len(known[a] & known[b]) >= 80 * len(known[a] | known[b]) for a, b in links)
    assert grouped(links, known) == grouped(similar(known, 80), known)


@pytest.mark.parametrize("n", [1, 2, 5, 17, 90, 400])
def test_similar_sets_share_a_path(n):
    rnd, like = np.random.default_rng(n), jaccard.Similarity(4, 85)
    for _ in range(60):
        x = np.unique(rnd.integers(0, 2**63, n).astype(np.uint64))
        drop, new = rnd.integers(0, max(1, n // 8) + 1), rnd.integers(0, max(1, n // 8) + 1)
        y = np.unique(np.concatenate([rnd.permutation(x)[drop:], rnd.integers(0, 2**63, new).astype(np.uint64)]))
        both = len(np.intersect1d(x, y))
        if len(y) and 100 * both >= 85 * (len(x) + len(y) - both):
            (a, ca), (b, cb) = jaccard.paths(x, like), jaccard.paths(y, like)
            shared = np.isin(a, b)
            space = (ca // jaccard._CODES, cb // jaccard._CODES)
            need = {c: max(1, (ca[space[0] == c] % jaccard._CODES).max(), (cb[space[1] == c] % jaccard._CODES).max()) for c in set(space[0].tolist()) & set(space[1].tolist())}
            assert any(shared[space[0] == c].sum() >= least for c, least in need.items())


def test_shingles_are_those_of_the_words():
    texts = ["a b c d e", "A  B\tc\nd E", "a b c d", "", "a b", "x" * 100_000, "a b c d e a b c d e"]
    sets = [set(s.tolist()) for s in shingles.shingle_sets(texts, 4)]
    assert [len(s) for s in sets] == [len(grams(t, 4)) for t in texts]
    assert sets[0] == sets[1] and sets[2] < sets[0] and sets[0] <= sets[6]


def test_exact_groups(odd):
    rows = odd.select("doc_id", "text").collect()
    groups = collections.defaultdict(list)
    for r in rows:
        groups[(r.text or "").translate(LOWER)].append(r.doc_id)
    want = collections.Counter()
    for members in groups.values():
        keep = max((i for i in members if i is not None), default=None)
        want.update((repr(i), keep, len(members), i == keep) for i in members)
    assert collections.Counter((repr(r.doc_id), r.keep_id, r.group_size, r.kept) for r in exact.deduplicate(odd).collect()) == want


def test_identifiers_that_fail_are_not_trusted(spark, monkeypatch):
    texts = ["first", "first", "second", "third", "Third"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    true = exact.recipes
    monkeypatch.setattr(exact, "recipes", lambda d: true(d).selectExpr("doc_id", "text_sha256", "transform(recipe, x -> 1L) as recipe", "checks"))
    assert {r.doc_id: r.keep_id for r in exact.deduplicate(df).collect()} == {0: 1, 1: 1, 2: 2, 3: 4, 4: 4}


def test_chunks_are_the_text(spark, odd):
    from pyspark.sql import functions as F

    joined = odd.select(exact.normalised(F.col("text")).alias("t")).select("t", F.array_join(F.regexp_extract_all("t", F.lit(exact.CHUNK), F.lit(0)), "").alias("j"))
    assert joined.where("t <> j").count() == 0


@pytest.mark.parametrize("seed", [0, 1])
def test_components(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(900 + i, 901 + i) for i in range(40)] + [(5, 5), (7, None)]
    links += [(2_000, 2_000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    clean = [(a, b) for a, b in links if b is not None]
    want = grouped(clean, {n for p in clean for n in p})
    assert {r.node: r.component for r in components.components(df).collect()} == {n: c for n, c in want.items() if n != c}


def vectors_table(spark, rng, n, d=16):
    x = rng.normal(size=(n, d))
    for i in range(1, n):
        if rng.random() < 0.6:
            x[i] = x[rng.integers(0, i)] * rng.uniform(0.5, 2) + rng.normal(size=d) * rng.choice([0, 0.05, 0.3])
    return [(i, [float(v) for v in x[i].astype(np.float32)], int(i % 2)) for i in range(n)]


def brute_vectors(rows):
    usable = [(i, np.array(v, float), label) for i, v, label in rows
              if i is not None and label is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    links, degree = [], collections.Counter()
    for p, (i, x, a) in enumerate(usable):
        for j, y, b in usable[:p]:
            if a == b and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                links.append((i, j))
                degree[i] += 1
                degree[j] += 1
    of = grouped(links, [i for i, _, _ in usable])
    return {i: (degree[i], of.get(i, i), of.get(i, i) == i) for i, _, _ in rows}


@pytest.mark.parametrize("shard", [1_000, 60])
def test_vectors(spark, monkeypatch, shard):
    monkeypatch.setattr(vectors, "SHARD", shard)
    rows = vectors_table(spark, np.random.default_rng(shard), 300)
    nan, inf = float("nan"), float("inf")
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [nan] * 16, 1), (903, [inf, *[1.0] * 15], 1), (904, rows[0][1], None), (905, [], 1),
             (906, [None, *[1.0] * 15], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (909, [1e-30, 2e-30], 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    want = brute_vectors(rows)
    assert got.keys() == want.keys()
    found, true = sum(g[0] for g in got.values()), sum(w[0] for w in want.values())
    assert 0.9 * true <= found <= true and sum(got[i] == want[i] for i in want) >= 0.9 * len(want)
    if shard == 1_000:
        assert got == want


def test_repeated_and_empty_vectors(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    a, b = [1.0, 0.0], [0.0, 1.0]
    got = vectors.near_duplicates(spark.createDataFrame([(1, a, 0), (1, b, 0), (2, a, 0), (3, b, 0), (None, a, 0), (2, a, 0)], schema)).collect()
    assert sorted((repr(r.vec_id), r.n_links, r.component_id) for r in got) == sorted(
        [("1", 2, 1), ("1", 1, 1), ("2", 2, 1), ("2", 2, 1), ("3", 1, 1), ("None", 0, None)])
    assert vectors.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def brute_links(x, least=0.98):
    """Degree and smallest reachable number of each vector."""
    x = x.astype(np.float64)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    like = x @ x.T >= least
    np.fill_diagonal(like, False)
    first, seen = np.full(len(x), -1), np.zeros(len(x), bool)
    for i in range(len(x)):
        front = np.array([i]) if not seen[i] else []
        while len(front):
            seen[front], first[front] = True, i
            front = np.flatnonzero(like[front].any(0) & ~seen)
    return like.sum(1), first


@pytest.mark.parametrize("n,noise", [(3_000, 0.1), (10_000, 0.1), (3_000, 0.19)])
def test_dense_groups_keep_their_links(spark, n, noise):
    rng = np.random.default_rng(n)
    dense = rng.normal(size=64) + noise * rng.normal(size=(n, 64))
    x = np.concatenate([dense, rng.normal(size=(800, 64))])
    x[-200:] = x[-400:-200] + 0.05 * rng.normal(size=(200, 64))
    x = x[rng.permutation(len(x))].astype(np.float32)
    degree, first = brute_links(x)
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>, label int")
    got = sorted(vectors.near_duplicates(df).collect(), key=lambda r: r.vec_id)
    assert [r.n_links for r in got] == degree.tolist()
    assert [r.component_id for r in got] == first.tolist()


def test_labels_that_the_audit_finds_low_are_compared_exactly(spark, monkeypatch):
    rows = vectors_table(spark, np.random.default_rng(5), 300)
    true = vectors._links
    monkeypatch.setattr(vectors, "SHARD", 60)
    monkeypatch.setattr(vectors, "_links", lambda *a: true(*a).limit(0))
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == brute_vectors(rows)


def test_audit_draws_until_it_sees_links(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3_000, 16))
    x[-20:] = x[-40:-20] * 2 + 0.001
    classes = spark.createDataFrame([(i, v.tolist(), 1, 1) for i, v in enumerate(x)], "node bigint, embedding array<double>, label int, copies bigint")
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert sum(n for n, _ in vectors._audit(classes, none, 0.98).values()) == 20
    assert np.isnan(vectors._audited(classes.limit(1), none, 0.98))


def test_audit_measures_recall(spark):
    rows = vectors_table(spark, np.random.default_rng(9), 80)
    classes = spark.createDataFrame([(i, v, label, 1) for i, v, label in rows], "node bigint, embedding array<float>, label int, copies bigint")
    pairs = vectors._links(classes, 0.98, 2)
    assert vectors._audited(classes, pairs, 0.98) == 1.0
    assert vectors._audited(classes, pairs.limit(0), 0.98) == 0.0


def test_empty_tables(empty):
    assert exact.deduplicate(empty).count() == 0
    assert jaccard.near_duplicates(empty).count() == 0

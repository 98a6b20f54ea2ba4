"""Merkle manifest against a plain tree in memory."""

import hashlib
import zlib

import parity
import pytest

from paylake.llm import merkle

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, lower=False):
    text = r.text
    if lower and text is not None:
        text = text.translate({c: c + 32 for c in range(65, 91)})
    return h(*[field(v) for v in (r.doc_id, r.source, r.lang, r.n_chars, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def walk(tree, i):
    """Siblings before and after node ``i`` on every level."""
    for nodes in tree[:-1]:
        first = i - i % 8
        yield nodes[first:i], nodes[i + 1:first + 8]
        i //= 8


def brute(rows):
    langs = sorted({r.lang for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees, ordered = {}, {}
    for lang in langs:
        own = sorted((r for r in rows if r.lang == lang), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r)))
        ordered[lang], trees[lang] = own, levels([leaf(r) for r in own])
    top = levels([trees[lang][-1][0] for lang in langs])
    out = []
    for n, lang in enumerate(langs):
        for i, r in enumerate(ordered[lang]):
            path = [*walk(trees[lang], i), *walk(top, n)]
            at = leaf(r, r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0)
            for left, right in path:
                at = h(*left, at, *right)
            root = top[-1][0]
            out.append((repr(r.doc_id), leaf(r), trees[lang][-1][0], root, h(*[x for left, right in path for x in left + right]), at, at == root))
    return sorted(out)


def found(df):
    return sorted((repr(r.doc_id), r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_equals_brute_force(spark, n):
    rows = [(i * 3, f"Text {i}", "a" if i % 20 else None, "s", i) for i in range(n)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    assert found(merkle.manifest(df)) == brute(df.collect())


def test_many_groups(spark):
    rows = [(i, "T" * (i % 3), chr(200 + i % 90), None, None) for i in range(150)]
    df = spark.createDataFrame(rows, DOCUMENTS)
    assert found(merkle.manifest(df)) == brute(df.collect())


def test_odd_rows(odd, empty):
    assert found(merkle.manifest(odd)) == brute(odd.collect())
    assert found(merkle.manifest(empty)) == []


@pytest.mark.parametrize("every", [1, 3])
def test_result_does_not_depend_on_what_is_stored(spark, every):
    df = spark.createDataFrame([(i, f"Text {i}", "a" if i % 9 else "b", "s", i) for i in range(700)], DOCUMENTS)
    assert found(merkle.manifest(df, every)) == brute(df.collect())


def test_equals_sql(spark):
    assert parity.compare(spark, parity.sql_engine(parity.sf_dir("0.01")), "op13_merkle_manifest", parity.sf_dir("0.01")) == ""


def test_tampering_shows(spark, sf):
    from paylake.llm.queries import op13_merkle_manifest

    rows = op13_merkle_manifest(spark, sf).collect()
    assert any(not r.verified for r in rows) and all(r.verified == (r.folded_root == r.root) for r in rows)
    assert all(r.verified for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3)

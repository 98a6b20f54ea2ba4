"""Hard negatives against brute force, and the bounds they rest on."""

import numpy as np
import parity
import pytest

from paylake.llm import negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, row string"


def brute(rows):
    """The rule, pair by pair; ``rows`` are (id, vector, label)."""
    live = {}
    for i, e, label in rows:
        if i is None or label is None or e is None or any(x is None or not np.isfinite(x) for x in e):
            continue
        v = tuple(int(np.floor(256 * float(np.float32(x)))) for x in e)
        live[(i, (label + 1) % 10 if i % 7 == 0 else label, v)] = None
    live, out = list(live), []
    for a in live:
        if a[0] % 50:
            continue
        scored = [(sum(x * y for x, y in zip(a[2], b[2])), b) for b in live if b[0] != a[0] and len(b[2]) == len(a[2])]
        scored.sort(key=lambda s: (-s[0], s[1][0]))
        for p, pos in [s for s in scored if s[1][1] == a[1]][:5]:
            fits = [s for s in scored if s[1][1] != a[1] and 50 * p <= 100 * s[0] <= 95 * p]
            out += [(a[0], pos[0], n, neg[0], p, score) for n, (score, neg) in enumerate(fits[:3], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(i, e, label, 1.0, "x") for i, e, label in rows], SCHEMA)


def made(n, d, seed, labels=4, wide=0.5):
    rnd = np.random.default_rng(seed)
    centre = rnd.normal(0, wide, (labels, d))
    of = np.where(rnd.random(n) < 0.4, 0, rnd.integers(0, labels, n))
    x = (centre[of] + rnd.normal(0, wide, (n, d))).astype(np.float32)
    return [(i * 5, x[i].tolist(), int(of[i])) for i in range(n)]


@pytest.mark.parametrize("d", [1, 3, 17, 64])
def test_equals_brute_force(spark, d, monkeypatch):
    monkeypatch.setattr(negatives, "LEAST", 40)
    rows = made(400, d, d)
    assert found(negatives.mined(table(spark, rows))) == brute(rows)


def test_blocks_of_anchors_and_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "MOST", 13)
    rows = made(300, 8, 5)
    assert found(negatives.mined(table(spark, rows))) == brute(rows)


def test_ties_repeats_nulls_and_lengths(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, rnd.integers(-1, 2, 4).astype(float).tolist(), int(i % 3)) for i in range(0, 300)]
    rows += rows[:60]
    rows += [(None, [1.0] * 4, 1), (1_000, None, 1), (1_050, [1.0, None, 0.0, 0.0], 1), (1_100, [float("nan")] * 4, 1), (1_150, [float("inf")] * 4, 1),
             (1_200, [1.0] * 4, None), (1_250, [], 0), (1_300, [], 0), (1_301, [], 1), (1_350, [1.0, 1.0], 0), (1_400, [1.0, 0.5], 0), (1_401, [0.7, 0.5], 1), (-50, [1.0] * 4, 1)]
    assert found(negatives.mined(table(spark, rows))) == brute(rows)


def test_scores_beyond_doubles_are_exact(spark):
    rnd = np.random.default_rng(4)
    rows = [(i * 10, (rnd.normal(0, 20_000, 32)).astype(np.float32).tolist(), int(i % 2)) for i in range(60)]
    assert found(negatives.mined(table(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert found(negatives.mined(table(spark, []))) == []


def test_equals_sql(spark):
    assert parity.compare(spark, parity.sql_engine(parity.sf_dir("0.01")), "op12_hard_negatives", parity.sf_dir("0.01")) == ""


def test_bounds_hold_and_get_closer():
    rnd = np.random.default_rng(1)
    for d in (5, 16, 64, 70):
        a, b = (np.floor(256 * (rnd.normal(0, 1, (40, d)) + rnd.normal(0, 1, (40, 1)))) for _ in range(2))
        exact, reached = a @ b.T, []
        for level in range(len(negatives._levels(d))):
            middle, reach = negatives.bounds(negatives.summary(a).astype(float), negatives.summary(b).astype(float), d, level)
            assert (np.abs(exact - middle) <= reach + 1e-5 * np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)) + 1).all()
            reached.append(reach.mean())
        assert reached == sorted(reached, reverse=True)


def test_rows_outside_the_bounds_are_not_scored(monkeypatch):
    d, rnd = 16, np.random.default_rng(3)
    x = np.floor(256 * np.concatenate([np.full((50, d), 1.0), np.full((950, d), -1.0)]) + rnd.integers(-9, 9, (1_000, d)))
    side = negatives._Side.__new__(negatives._Side)
    side.vector, side.summary, side.length = x, negatives.summary(x).astype(float), np.linalg.norm(x, axis=1)
    low, high = np.full(1_000, 500_000), np.full(1_000, 2_000_000)
    _, here = negatives._left(side, side, np.arange(20), np.arange(1_000), low, high, d)
    assert set(here.tolist()) == set(range(50))


def test_chunks_of_a_block_give_the_same_rows(monkeypatch):
    import pandas as pd

    rnd = np.random.default_rng(6)
    x = np.floor(256 * rnd.normal(0, 1, (200, 12))).round(-2)
    rows = pd.DataFrame({"id": np.arange(200), "row": np.arange(200), "label": rnd.integers(0, 3, 200),
                         "vector": [v.tobytes() for v in x.astype("<i4")], "summary": [v.tobytes() for v in negatives.summary(x).astype("<f4")]})
    anchors = rows.head(40).assign(lows=[[0, -10**6]] * 40, highs=[[10**6, 10**5]] * 40)
    whole = negatives._met(anchors, rows, 3, same=False)
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "ROWS", 11)
    assert negatives._met(anchors, rows, 3, same=False).equals(whole) and len(whole) > 100

"""Nearest neighbours against all inner products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellweave.llm import nearest


def table(spark, rows, kind="double"):
    return spark.createDataFrame([(i, x, "c") for i, x in rows], f"vec_id long, embedding array<{kind}>, code string")


def brute(rows, k, every):
    """(query_id, rank, vec_id, score) by scoring all pairs."""
    size = max((len(x) for _, x in rows if x), default=0)
    kept = [(i, np.array(x + [0.0] * (size - len(x)))) for i, x in rows if x and None not in x and np.isfinite(x).all() and any(x)]
    out = []
    for q, (i, x) in enumerate(kept):
        if i is not None and i % every == 0:
            scored = sorted((-float((x * y).sum()), j is None, j or 0, p) for p, (j, y) in enumerate(kept) if p != q)
            out += [(i, r + 1, None if none else j, -s) for r, (s, none, j, _) in enumerate(scored[:k])]
    return sorted(out, key=repr)


def found(df, k, every=20):
    return sorted(map(tuple, nearest.search(df, F.col("vec_id") % every == 0, k).collect()), key=repr)


@pytest.fixture
def small(monkeypatch):
    for name, value in (("QUERY_ROWS", 7), ("BLOCK_ROWS", 50), ("SLICE", 16), ("SAMPLE_ROWS", 60), ("PAIRS", 64)):
        monkeypatch.setattr(nearest, name, value)


def clustered(n, size, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, size))
    x = centres[r.integers(0, 12, n)] + 0.6 * r.normal(size=(n, size))
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def test_small_tables_exactly(spark, small):
    x = clustered(400, 24, 1).astype(float).tolist()
    rows = [*enumerate(x)] + [(20, x[20]), (20, x[20]), (None, x[40]), (1000, [0.0] * 24), (1001, None), (1002, []), (1003, [None, 1.0]), (1020, [float("nan")] * 24)]
    rows += [(1040, [float("inf")] + x[0][1:]), (1060, x[0][:9]), (2000, [5.0]), (1004, [v * 3 for v in x[60]])] + [(3000 + i, x[60]) for i in range(60)]
    df = table(spark, rows)
    assert found(df, 20) == brute(rows, 20, 20)
    assert nearest.search(df, F.col("vec_id") % 20 == 0).columns == ["query_id", "rank", "vec_id", "score"]


def test_few_candidates_and_empty_tables(spark, small):
    rows = [(0, [1.0, 2.0]), (1, [2.0, -1.0]), (20, [1.0, 2.0])]
    assert found(table(spark, rows), 20) == brute(rows, 20, 20)
    assert found(table(spark, rows[:1]), 20) == [] and found(table(spark, []), 20) == [] and found(table(spark, [(1, [1.0])]), 20) == []


@pytest.mark.parametrize("shape", ["clustered", "noise"])
def test_recall(spark, shape):
    x = clustered(6000, 64, 2) if shape == "clustered" else np.random.default_rng(3).normal(size=(6000, 64)).astype(np.float32)
    df = table(spark, [(i, row.tolist()) for i, row in enumerate(x)], "float")
    rows = nearest.search(df, F.col("vec_id") % 20 == 0).collect()
    y = x.astype(float)
    scores = y[::20] @ y.T
    scores[np.arange(300), np.arange(0, 6000, 20)] = -np.inf
    true = {(20 * q, int(v)) for q, best in enumerate(np.argsort(-scores, axis=1)[:, :20]) for v in best}
    assert len(rows) == len(true) == 6000
    assert len({(r["query_id"], r["vec_id"]) for r in rows} & true) >= 0.999 * len(true)
    assert all(r["score"] == float((y[r["query_id"]] * y[r["vec_id"]]).sum()) for r in rows)


def test_errors_stay_within_their_bound_and_codes_spare_work():
    x = clustered(5000, 64, 4).astype(float)
    made = nearest.coder(x[:1000], 64)
    code, scale, error = made.encode(x)
    assert code.shape == (5000, nearest.BITS // 8)
    signs = np.unpackbits(code, axis=1) * 2.0 - 1
    q = x[:50]
    guess = (signs @ made.rotate(q).T) * scale[:, None] + q @ made.centre
    off = np.abs(guess - x @ q.T) / (error[:, None] * np.linalg.norm(q, axis=1))
    assert (off > nearest.CONFIDENCE).mean() < 0.001 and 0.5 < np.sqrt((off**2).mean()) < 1.5
    turned = made.rotate(x[:200])
    assert np.allclose(turned @ turned.T, x[:200] @ x[:200].T)

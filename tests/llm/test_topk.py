"""Exact search against a full comparison."""

import math

import numpy as np
import pytest

from linkledger.llm import topk


def brute(rows, is_query, k):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = {}
    for q, v in good:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:k]
            out[q] = [(i, -s) for s, i in scored]
    return out


def run(spark, rows, divisor, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    v = topk.integer_vectors(df, "embedding", 1024)
    got = {}
    for r in topk.search(v, v.filter(f"vec_id % {divisor} = 0"), **sizes).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(got[r.query_id])
    return got


@pytest.mark.parametrize("dims,sizes", [(8, {}), (32, {"shard_rows": 50, "block_rows": 7}), (64, {"shard_rows": 400})])
def test_same_as_full_comparison(spark, dims, sizes):
    rng = np.random.default_rng(dims)
    centres = rng.normal(size=(5, dims))
    rows = [(i, [float(x) for x in np.float32(0.2 * (centres[i % 5] + 0.3 * rng.normal(size=dims)))]) for i in range(700)]
    rows += [(i, rows[3][1]) for i in range(700, 900)]
    assert run(spark, rows, 10, **sizes) == brute(rows, lambda i: i % 10 == 0, 10)


def test_positive_negative_and_few(spark):
    rows = [(i, [float((-1) ** (i * j) * (i % 3 - 1)) for j in range(6)]) for i in range(40)]
    assert run(spark, rows, 5, shard_rows=9) == brute(rows, lambda i: i % 5 == 0, 10)
    few = rows[:6]
    assert run(spark, few, 5) == brute(few, lambda i: i % 5 == 0, 10)
    opposite = [(i, [1.0 if i % 2 else -1.0]) for i in range(4)]
    assert run(spark, opposite, 1) == brute(opposite, lambda i: True, 10)


def test_unsound_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]),
            (5, [1.0]), (6, []), (10, [0.5, -0.5])]
    got = run(spark, rows, 5)
    assert got[0] == [(5, 1024 * 1024), (6, 0), (10, 512 * 1024 - 512 * 2048)]
    assert set(got) == {0, 5, 10}
    assert run(spark, [(1, None)], 1) == {}


@pytest.mark.parametrize("seed,k,block", [(1, 10, 512), (2, 3, 40), (3, 1, 64)])
def test_threshold_rises_and_fewer_are_scored(seed, k, block):
    """Results of a full comparison, with whole scores of a part of the documents only; later blocks add few."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, 32))
    vectors = np.rint(400 * (centres[rng.integers(0, 12, 3000)] + 0.4 * rng.normal(size=(3000, 32)))).astype(np.int64)
    ids = rng.permutation(5000)[:3000]
    shard = topk.Shard(ids, vectors, block)
    for own in ids[:40].tolist():
        query = vectors[ids == own][0]
        got = list(zip(*(x.tolist() for x in shard.search(query, own, k))))
        want = sorted(((-int(v @ query), i) for i, v in zip(ids.tolist(), vectors) if i != own))[:k]
        assert got == [(i, -s) for s, i in want]
    assert shard.scored < 0.2 * 40 * 3000
    sparse = vectors * (rng.random(vectors.shape) < 0.1)
    shard = topk.Shard(ids, sparse, block)
    query = sparse[np.argmax(np.count_nonzero(sparse, axis=1))]
    scores = sparse @ query
    ids_, found = shard.search(query, -1, k)
    assert found.tolist() == sorted(scores.tolist(), reverse=True)[:k]
    assert shard.scored < np.count_nonzero(scores > 0)

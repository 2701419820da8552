"""Groups of near copies against a comparison of all pairs."""

import random

import numpy as np
import pytest

from linkledger.llm import ngram_join as nj
from linkledger.llm.components import components
from linkledger.llm.common import Stages
from linkledger.llm.shingles import shingle_set
from tests.llm import plain


def brute(rows):
    number, sets = plain.groups([t for _, t in rows])
    least = {}
    for g, (d, _) in zip(number, rows):
        least[g] = min(least.get(g, d), d)
    return sorted((d, len(s), least[g]) for (d, _), s, g in zip(rows, sets, number))


def run(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, key int, n int")
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in nj.near_groups(df).collect())


def corpus(seed, n=160):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)] + ["é", "Ärger,", "x\xa0y"]
    passage = " ".join(rng.choices(vocabulary, k=25))
    texts = []
    for i in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            w = rng.choice(texts).split(" ")
            for _ in range(rng.randint(0, max(1, len(w) // 30))):
                at = rng.randrange(len(w) + 1)
                if rng.random() < 0.5 or len(w) < 2:
                    w.insert(at, rng.choice(vocabulary))
                else:
                    del w[min(at, len(w) - 1)]
            texts.append(" ".join(w))
        else:
            t = " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 4, 5, 6, 9, 20, 60, 200])))
            texts.append(t + " " + passage if kind < 0.8 else t)
    return [(100 + 3 * i, t.upper() if i % 7 == 0 else t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed,block", [(1, 2048), (2, 5)])
def test_same_as_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(nj, "BLOCK", block)
    monkeypatch.setattr(nj, "TASK_ROWS", 300)
    rows = corpus(seed)
    rng = random.Random(seed)
    rng.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A  B "), (6, "a b c"), (7, "a b"), (7, "a b"),
            (8, "z " * 30000)]
    got = run(spark, rows)
    assert [g for g in got if g[0] in (4, 5, 7)] == [(4, 1, 4), (5, 1, 4), (7, 1, 4), (7, 1, 4)]
    assert [g for g in got if g[0] in (1, 2, 3, 6, 8)] == [(1, 0, 1), (2, 0, 2), (3, 0, 3), (6, 1, 6), (8, 1, 8)]
    assert run(spark, []) == []


def test_null_ids(spark):
    text = " ".join(f"q{i}" for i in range(60))
    df = spark.createDataFrame([(None, text), (9, text + " more"), (None, "other words")], "doc_id long, text string")
    got = sorted((r.n_shingles, r.doc_id or 0, r.component_id or 0) for r in nj.near_groups(df).collect())
    assert got == [(1, 0, 0), (56, 0, 9), (57, 9, 9)]


def test_bound_never_drops_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        base = rng.integers(0, 2**64, n, dtype=np.uint64)
        x = np.unique(np.concatenate([base[: n - n // 10], rng.integers(0, 2**64, n // 12, dtype=np.uint64)]))
        y = np.unique(base)
        common = len(np.intersect1d(x, y))
        if 4 * common >= 3 * (len(x) + len(y) - common):
            bits = min(nj.bitmap_bits(nj.band(len(v))) for v in (x, y))
            a, b = (nj.folded(nj.bitmap(v, nj.bitmap_bits(nj.band(len(v)))), bits) for v in (x, y))
            assert np.bitwise_count(a ^ b).sum() <= nj.most_apart(np.int64(len(x)), np.int64(len(y)))
            assert abs(nj.band(len(x)) - nj.band(len(y))) <= 1


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 300)] + [(7, 7), (2000, 1500)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.component for r in components(df, Stages(spark, "t"), "c").collect()}
    assert got == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(300)}, 2000: 1500, 1500: 1500}


def test_shingles_of_words():
    assert len(shingle_set("a b c d e f")) == 2 and len(shingle_set("a b c d e a b c d e a")) == 5
    assert (shingle_set("A b") == shingle_set("a\tB\n")).all() and len(shingle_set("a\xa0b")) == 1

"""Hits of benchmark windows against a plain search."""

import hashlib
import random
import re

import numpy as np
import pytest

from linkledger.llm import decontam

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items):
    out = []
    for d, text in docs:
        w = words(text)
        hit, ids = set(), set()
        for i, t in items:
            ws = words(t)
            n = min(10, len(ws))
            for s in range(len(ws) - n + 1) if n else ():
                for p in range(len(w) - n + 1):
                    if w[p:p + n] == ws[s:s + n]:
                        hit.update(range(p, p + n))
                        ids.add(str(i))
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((d, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out)


def run(spark, docs, items, **options):
    d = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, matched string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.report(d, b, **options).collect()
    return sorted(tuple(r) for r in rows), d, b


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"block_words": 40}), (3, {})])
def test_same_as_plain_search(spark, seed, options):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(6 if seed == 3 else 40)] + ["É", "naïve"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 9, 10, 11, 30]) if i % 5 else 25))) for i in range(5, 25)]
    items = [(i, t) for i, t in items if len(t.split()) > (1 if seed == 1 else 8)]
    docs = []
    for d in range(60):
        text = rng.choices(vocabulary + ["other", "x9"], k=rng.choice([0, 1, 5, 40]))
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(items)[1].upper().split()
            a = rng.randrange(len(w))
            at = rng.randint(0, len(text))
            text[at:at] = w[a: a + rng.randint(5, 30)]
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(text)))
    got, d, b = run(spark, docs, items, **options)
    want = brute(docs, items)
    assert got == want
    kept = decontam.clean_documents(d, b)
    assert kept.columns == ["doc_id", "text", "matched"]
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in want if not r[5]]


def test_longest_match_and_place(spark):
    item = " ".join(f"k{i}" for i in range(30))
    text = "a b " + " ".join(f"K{i}" for i in range(3, 20)) + " c " + " ".join(f"k{i}" for i in range(0, 12))
    b = decontam.Block([("7", decontam.words(item))])
    n, hits, longest = decontam._matched([None, text, ""], b)
    assert n == [0, 32, 0] and hits[1] == [(20, 32), (2, 19)] or sorted(hits[1]) == [(2, 19), (20, 32)]
    assert longest[1] == {0: (3, 2, 17)}


def test_edges(spark):
    text = " ".join(f"w{i}" for i in range(12))
    docs = [(1, None), (2, ""), (3, text), (3, text), (4, "y " * 40000 + text)]
    got, *_ = run(spark, docs, [(1, text), (1, text), (None, text), (2, None), (3, "..."), (4, "")])
    assert [g[:4] for g in got] == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 12, 12, 1), (3, 12, 12, 1), (4, 40012, 12, 1)]
    got, *_ = run(spark, docs, [])
    assert not any(g[5] for g in got)
    assert run(spark, [], [(1, text)])[0] == []


def test_suffix_array():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 4, 300)
    order = decontam.suffix_array(text, 16)
    keys = [tuple(text[i:i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(300))

"""The index against counting and plain distances."""

import random

import numpy as np
import pytest

from linkledger.llm import fmindex


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def test_counts():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 11, 1000)
    wavelet = fmindex.Wavelet(symbols, 11)
    symbol, at = rng.integers(0, 11, 500), np.append(rng.integers(0, 1001, 498), [0, 1000])
    n, smaller = wavelet.before(symbol, at)
    assert n.tolist() == [int((symbols[:a] == s).sum()) for s, a in zip(symbol, at)]
    assert smaller.tolist() == [int((symbols[:a] < s).sum()) for s, a in zip(symbol, at)]


@pytest.mark.parametrize("letters,n,read", [("ab", 300, 48), ("abcdeé", 900, 2), ("aÿ", 40, 0), ("abcdefghij", 600, 48)])
def test_both_halves_find_every_word_near(monkeypatch, letters, n, read):
    monkeypatch.setattr(fmindex, "READ", read)
    monkeypatch.setattr(fmindex, "TOGETHER", 100)
    rng = random.Random(n)
    words = set()
    while len(words) < n:
        w = list(rng.choice(sorted(words))) if words and rng.random() < 0.6 else rng.choices(letters, k=rng.randint(2, 12))
        w[rng.randrange(len(w)):][:rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 2))
        at = rng.randrange(len(w) + 1)
        w[at: at + rng.randint(0, 1)] = rng.choices(letters, k=rng.randint(0, 1))
        if len(w) > 1:
            words.add("".join(w))
    words = sorted(words)
    index = fmindex.Index(words)
    queries = words + ["zz", "zaz", "aaz", "z" * 6]
    left, right = (list(zip(*map(np.ndarray.tolist, index.near(queries, side)))) for side in (True, False))
    assert len(set(left)) == len(left) and len(set(right)) == len(right)
    want = {(i, j) for i, q in enumerate(queries) for j, w in enumerate(words) if one_edit(q, w)}
    assert set(left) | set(right) == want
    for i, j in left:
        assert words[j].startswith(queries[i][:len(queries[i]) // 2])
    for i, j in right:
        assert words[j].endswith(queries[i][len(queries[i]) // 2:])
    keeps = {(i, j) for i, j in want if words[j].startswith(queries[i][:len(queries[i]) // 2])
             and one_edit(queries[i][len(queries[i]) // 2:], words[j][len(queries[i]) // 2:])}
    assert set(left) == {(i, j) for i, j in keeps if len(queries[i]) > 1}


def test_small_indexes():
    assert [len(x) for x in fmindex.Index([]).near(["abc"], True)] == [0, 0]
    index = fmindex.Index(["abcd"])
    assert index.near(["abcde", "abcd", "xbcd", "bcd"], True)[0].tolist() == [0]
    assert index.near(["abcde", "abcd", "xbcd", "bcd"], False)[0].tolist() == [2, 3]
    with pytest.raises(ValueError):
        fmindex.Index(["b", "a"])

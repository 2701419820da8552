"""Packings that hold every token once, against bounds and brute force."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from linkledger.llm import packing
from linkledger.llm.tokens import Encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_of_whole_texts(tokenizer, monkeypatch):
    from linkledger.llm import tokens

    monkeypatch.setattr(tokens, "_WORDS", 60)
    e = Encoder(PATH)
    rng = random.Random(4)
    parts = ["the", " ", "  ", "\n", " \n", "\t", "don't", "'s", "12", "Ärger", "…", "\xa0", "x,", "<|endoftext|>", "日本", "😀", "ſ", "ǅ", "ᾼ", "thon.", "née!", "x)", "²", "ʰ", "x,!!", "a***", "WORD.!!", "ab'", "o's.", "z|", "q_", "ª."]
    texts = ["", " ", "  ", "a", " a ", "a  b", "a\n b", "a \n", "\n a", "a\x85 b"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 60))) for _ in range(800)]
    texts += [" ".join(rng.choices([p for p in parts if p.strip()], k=rng.randint(1, 300))) for _ in range(100)]
    for t in texts:
        assert e.encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids, repr(t)


def test_ids_of_texts_with_added_tokens(tokenizer):
    """As the plain tokenizer has them: one id for the token, wherever it stands."""
    e = Encoder(PATH)
    assert e.encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    for t in ("<|endoftext|>", "x<|endoftext|>y", "two\nlines <|endoftext|>\n\nthere ", "<|endoftext|><|endoftext|> the end"):
        assert e.encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids
        assert 50256 in e.encode(t)


def used(groups, capacity):
    held, n = {}, 0
    for times, of in groups:
        assert times > 0 and sum(k * each for k, each in of) <= capacity
        n += times
        for k, each in of:
            held[k] = held.get(k, 0) + times * each
    return held, n


def optimum(lengths, capacity):
    best = len(lengths)

    def go(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(lengths):
            best = len(bins)
            return
        for j in range(len(bins)):
            if bins[j] + lengths[i] <= capacity and bins[j] not in bins[:j]:
                bins[j] += lengths[i]
                go(i + 1, bins)
                bins[j] -= lengths[i]
        go(i + 1, bins + [lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


def test_plan_against_optimum():
    rng = random.Random(1)
    worse = 0
    for _ in range(150):
        capacity = rng.choice([10, 20, 30])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(1, 10))]
        counts = {n: lengths.count(n) for n in set(lengths)}
        held, n = used(packing.plan(counts, capacity), capacity)
        assert held == counts
        best = optimum(lengths, capacity)
        worse += n - best
        left = dict(counts)
        fixed = packing._reduce(left, capacity)
        rest = [k for k, c in left.items() for _ in range(c)]
        assert sum(t for t, _ in fixed) + (optimum(rest, capacity) if rest else 0) == best
    assert worse <= 8


def test_plan_of_many():
    rng = np.random.default_rng(2)
    lengths = np.minimum(2048, rng.lognormal(5.5, 1.2, 200_000).astype(int) + 1)
    counts = {int(k): int(c) for k, c in zip(*np.unique(lengths, return_counts=True))}
    held, n = used(packing.plan(counts), 2048)
    assert held == counts
    least = -(-int(lengths.sum()) // 2048)
    assert n <= least * 1.002 + 2


def test_packing(spark, tokenizer):
    rng = random.Random(7)
    texts = [None, "", "a", "word " * 5000, "word " * 5000, " \n x"] + [
        " ".join(rng.choices(["the", "ing", "zebra", "Öl"], k=rng.choice([1, 30, 500, 2047, 2048, 4096]))) for _ in range(60)]
    rows = [(i if i != 5 else None, t, 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part int").repartition(5)
    placed = packing.packed(df, PATH, keep_ids=True).cache()
    got = placed.collect()
    whole = {}
    for r in got:
        assert 1 <= r.length <= 2048 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        whole.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        own = sorted(whole[i if i != 5 else None], key=lambda r: r.piece)
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        assert [x for r in own for x in r.ids] == ids
        assert [r.piece for r in own] == list(range(len(own))) and all(r.length == 2048 for r in own[1:])
        assert [r.start for r in own] == list(itertools.accumulate([0] + [r.length for r in own[:-1]]))
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 2
    packs = {r.sequence_id: len(r.ids) for r in packing.sequences(placed).collect()}
    assert packs == {s: sum(n for _, n in v) for s, v in by.items()}
    assert packing.packed(df.limit(0), PATH).count() == 0

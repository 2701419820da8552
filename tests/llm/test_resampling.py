"""Weights, the cutoff and ranks against plain versions."""

import hashlib
import math
import random
import re
import zlib

import pytest

from linkledger.llm import resampling
from linkledger.llm.common import Stages

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, target, longest=1, least=20, percent=10):
    def features(text):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
        grams = [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(g.encode()) % 10_000 for g in grams]

    docs, held = [features(t) for _, t in rows], [features(t)[1] for t in target]
    s, t = [0] * 10_000, [0] * 10_000
    for counts, lists in ((s, [d for _, d in docs]), (t, held)):
        for own in lists:
            for b in own:
                counts[b] += 1
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((b + 1) * (S + 10000) / ((a + 1) * (T + 10000)))) for a, b in zip(s, t)]
    out = []
    for (i, _), (n, own) in zip(rows, docs):
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in own)
        out.append([i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[:len(fit) * percent // 100], 1):
        r[4] = rank
    return [tuple(r[:5]) for r in out]


def corpus():
    rng = random.Random(9)
    names = ["Alpha", "beta,", "GAMMA", "d'elta", "été", "Émile", "x1", "日本", "zeta_eta", "a-b", "–", "Straße"]
    rows = [(i, " ".join(rng.choices(names, k=rng.randint(0, 60)))) for i in range(300)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (None, None), (None, rows[3][1] + " x" * 30), (500, ""), (501, None)]
    return rows, ["beta gamma " * 30, None, "été x1", ""]


@pytest.mark.parametrize("longest,percent", [(1, 10), (3, 35), (1, 0), (2, 100)])
def test_draw(spark, longest, percent):
    rows, target = corpus()
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int").repartition(4)
    held = spark.createDataFrame([(t,) for t in target], "text string")
    draw = resampling.Draw(longest=longest, percent=percent)
    got = resampling.resampled(docs, held, draw)
    assert [t for _, t in got.dtypes] == ["bigint"] * 5
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, plain(rows, target, longest, 20, percent)))


@pytest.mark.parametrize("run,most,rest", [(7, 3, 2), (50, 4, 1), (1000, 4096, 5), (13, 2, 40)])
def test_cutoff_of_ties_and_nulls(spark, run, most, rest):
    rng = random.Random(run)
    keys = [(rng.choice([-3, 0, 5, rng.randint(-50, 50)]), rng.choice([None, 1, 2, rng.randint(0, 99)]), row)
            for row in range(400)]
    df = spark.createDataFrame(keys, "score long, doc_id long, row long").repartition(6)
    order = sorted(keys, key=lambda x: (-x[0], x[1] is None, x[1] or 0, x[2]))
    stages = Stages(spark, "t")
    for k in (1, 40, 333, 400):
        found = resampling.cutoff(df, k, Stages(spark, "t"), run, most, rest)
        assert (found["score"], found["doc_id"], found["row"]) == order[k - 1]
    with pytest.raises(ValueError):
        resampling.cutoff(df, 401, stages)


def test_text_ids(spark):
    docs = spark.createDataFrame([(f"d{i}", "word " * 25) for i in range(40)] + [(None, "word " * 25)], "doc_id string, text string")
    got = resampling.resampled(docs, docs.select("text")).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4]


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resampling.resampled(none, none).count() == 0
    assert resampling.resampled(spark.createDataFrame([(1, "a " * 30)], "doc_id long, text string"), none).count() == 1

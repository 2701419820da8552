"""Variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import pytest
from test_fmindex import one_edit

from linkledger.llm import variants
from linkledger.llm.common import Stages

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if i is None else i}:{w}".encode())
            n[w if h % 199 else w[:h % len(w)] + w[h % len(w) + 1:]] += 1
    n = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [o for o in n if one_edit(w, o)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n.get(form[w]), root))
    return out


def corpus():
    rng = random.Random(6)
    stems = ["kitchen", "gärten", "Été-là", "Éclair", "eclair", "walking", "aaaaaa", "bananas", "straße", "ÀÀÀÀÀÀ"]
    words = []
    for stem in stems:
        words += [stem] * 300
        for weight in (30, 30, 5, 5, 5, 1):
            w = list(stem)
            at = rng.randrange(len(w))
            w[at: at + rng.randint(0, 1)] = rng.choice(["", "x", "é", "q", "a"])
            words += ["".join(w)] * weight + ["".join(w + [rng.choice("sxé")])] * (weight // 5)
    rng.shuffle(words)
    rows = [(i % 900 if i % 40 else None, " ".join(words[i * 8: i * 8 + 8]) + rng.choice([".", "\n", " kitchen1kitchen", "×÷"]))
            for i in range(len(words) // 8)]
    return rows + [(3, None), (4, ""), (None, "x" * 30_000), (5, "KITCHEN kitcheN " * 50), (5, "KITCHEN kitcheN " * 50)]


def test_variants(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(5)
    got = variants.variants(docs)
    assert dict(got.dtypes) == {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string",
                                "form_n": "bigint", "root": "string"}
    want = plain(rows)
    assert any(f and r != f for _, _, _, f, _, r in want) and any(r[2] == 0 for r in want)
    assert sorted(map(str, (tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in got.collect()))) \
        == sorted(map(str, want))


@pytest.mark.parametrize("block,task_words", [(20_000, 30_000), (7, 20), (30, 5)])
def test_blocks_find_the_same(spark, block, task_words):
    rng = random.Random(8)
    words = sorted({"und" + "".join(rng.choices("abc", k=rng.randint(3, 5))) for _ in range(150)}
                   | {"".join(rng.choices("abc", k=rng.randint(3, 5))) + "ing" for _ in range(150)})
    table = Stages(spark, "t").write(
        spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long").repartition(4), "words")
    got = variants.near_words(table, block=block, task_words=task_words).collect()
    want = {(a, b, j) for a in words for j, b in enumerate(words) if one_edit(a, b)}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(25)] + [("x", "y")], "word string, form string")
    got = dict(variants.roots(Stages(spark, "t").write(forms, "forms"), Stages(spark, "t")).collect())
    assert got == {**{f"w{i}": "w25" for i in range(25)}, "x": "y"}


def test_no_rows(spark):
    assert variants.variants(spark.createDataFrame([], "doc_id long, text string")).count() == 0

"""Fingerprints and their groups against plain versions."""

import itertools
import random
import re

import pytest
import xxhash

from linkledger.llm import simhash
from linkledger.llm.common import Stages

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=4):
    distinct = sorted(set(prints))
    root = {p: p for p in distinct}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in itertools.combinations(distinct, 2):
        if (a ^ b).bit_count() <= distance:
            root[find(a)] = find(b)
    return {p: find(p) for p in distinct}


def corpus(n=240):
    rng = random.Random(3)
    names = ["Uno", "DOS", "três", "vier", "five\t", "6", "SEVEN,", "acht", "neuf", "dix x", "Ä", "ä"]
    rows = []
    for i in range(n):
        kind = i % 6
        if kind < 3 or i < 12:
            text = " ".join(rng.choices(names, k=rng.randint(1, 60)))
        elif kind < 5:  # a near copy
            own = (rows[rng.randrange(len(rows))][1] or "").split(" ")
            own[rng.randrange(len(own))] = rng.choice(names)
            text = " ".join(own)
        else:
            text = rng.choice([None, "", " \n", "one", "one two", "Same text again and again here"])
        rows.append((rng.randrange(10_000) if i % 17 else None, text, "x"))
    return rows + rows[5:9]


def test_groups_of_texts(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string").repartition(5)
    got = simhash.near_groups(docs).collect()
    prints = [plain(t) for _, t, _ in rows]
    group = plain_groups(prints)
    least = {}
    for (i, _, _), p in zip(rows, prints):
        if i is not None:
            least[group[p]] = min(i, least.get(group[p], i))
    want = sorted((str(i), f"{p:016x}", str(least.get(group[p]))) for (i, _, _), p in zip(rows, prints))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want
    assert len({r.component_id for r in got}) < len(set(prints))


@pytest.mark.parametrize("block,small,segments", [(8192, 64, 3), (8, 64, 3), (8, 2, 3), (50, 4, 2), (8192, 3, 4), (20, 8, 5)])
def test_links_of_fingerprints(spark, monkeypatch, block, small, segments):
    """Dense balls, one hot segment value, and chance neighbours; blocks and forests keep the components."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(block + segments)
    prints = [0]
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints += [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for _ in range(40)]
    prints += [rng.getrandbits(43) << 21 | 5 for _ in range(60)] + [rng.getrandbits(64) for _ in range(40)]
    nodes = spark.createDataFrame(
        [(p - (p >> 63 << 64),) for p in set(prints)], "fingerprint long").repartition(3)
    found = simhash.links(simhash.units(simhash.placed(nodes, 4, segments), block)).collect()
    links = {(r.a % 2 ** 64, r.b % 2 ** 64) for r in found}
    assert all((a ^ b).bit_count() <= 4 and a != b for a, b in links)
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a, b in links:
        root[find(a)] = find(b)
    group = plain_groups(prints)
    assert len({(find(p), group[p]) for p in set(prints)}) == len({find(p) for p in prints}) == len(set(group.values()))


def test_large_group_of_near_copies_gives_few_links(spark):
    """A thousand fingerprints, all within two bits of one: a forest, not half a million pairs."""
    near = [sum(1 << b for b in held) for k in (0, 1, 2) for held in itertools.combinations(range(45), k)]
    nodes = spark.createDataFrame([(p,) for p in near], "fingerprint long")
    found = simhash.links(simhash.units(simhash.placed(nodes), 256))
    assert found.count() < 60 * len(near)
    assert simhash.components(found, Stages(spark, "t"), "c").select("component").distinct().count() == 1


def test_plan_covers_every_pair():
    for distance, segments in itertools.product(range(9), range(1, 8)):
        searched = {a: (n, r) for a, n, r in simhash.plan(distance, segments)}
        cuts = [64 * i // segments for i in range(segments + 1)]
        missed = [searched[a][1] + 1 if a in searched else 0 for a in cuts[:-1]]
        assert sum(missed) > distance  # more bits than allowed, if every segment is beyond its radius


def test_no_rows(spark):
    assert simhash.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_text():
    text = " ".join(str(i * i % 1009) for i in range(150_000))
    assert simhash.fingerprint(text) == plain(text)

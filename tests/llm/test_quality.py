"""Held-out accuracy of the classifiers, their parts, and edge rows."""

import zlib

import numpy as np
import pytest

from linkledger.llm import quality, toxicity
from linkledger.llm.ftrl import Ftrl, train
from linkledger.llm.labelled import remainder, training_rows

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def held_out(rows, labels, label):
    known = {r.doc_id: r[label] for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    return [(r, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]


def test_quality(spark, tables):
    docs, labels = tables
    rows = quality.scored(docs, quality.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    pairs = held_out(rows, labels, "quality")
    assert sum(r.predicted == y for r, y in pairs) / len(pairs) > 0.95


def test_toxicity(spark, tables):
    docs, labels = tables
    rows = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    pairs = held_out(rows, labels, "toxic")
    assert sum(r.predicted == y for r, y in pairs) / len(pairs) > 0.95


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_edge_rows(spark, module, label):
    docs = spark.createDataFrame(
        [(1, None, 0.5), (2, "", 0.5), (None, "some words", 0.1), (3, "bad " * 30000, 0.1), (3, "bad " * 30000, 0.1)],
        "doc_id long, text string, score double")
    labels = spark.createDataFrame(
        [(1, None, None), (2, 1, 0), (None, 1, 1), (3, 0, 1), (3, 1, 0), (77, 1, 1)], "doc_id long, quality int, toxic int")
    rows = module.scored(docs, module.fit(docs, labels)).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, set()).add(r.score)
    assert by[1] == by[2] and len(by[3]) == 1
    model = module.fit(docs, labels.limit(0))
    assert {r.score for r in module.scored(docs, model).collect()} == {0.5}
    assert module.scored(docs.limit(0), model).count() == 0


def test_good_documents_keep_columns(spark, tables):
    docs, labels = tables
    more = docs.selectExpr("*", "1 as quality_score", "label_x" if "label_x" in docs.columns else "2 as label")
    kept = quality.good_documents(more, quality.fit(docs, labels))
    assert kept.columns == more.columns and 0 < kept.count() < docs.count()


def test_shapes():
    assert [quality.shape(w) for w in ("Word", "WORD!!", "(x)", "12,", "***", "A", "aB")] == [
        "Xx", "XX!!", "(x)", "0,", "***", "Xx", "m"]


def test_ftrl_learns(spark):
    rng = np.random.default_rng(0)
    rows = [(int(y), [0, 1 + int(y) * 2 + int(rng.random() < 0.1), 9], [1.0, 1.0, 0.5], i)
            for i, y in enumerate(rng.integers(0, 2, 400))]
    df = spark.createDataFrame(rows, "label int, at array<int>, value array<float>, pick long")
    w = train(df, Ftrl(dims=16))
    assert w[3] > 0.5 and w[1] < -0.5 and w[12] == 0


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_against_distances():
    rng = np.random.default_rng(4)
    letters = np.array(list("abcé"))

    def word(n):
        return "x" + "".join(rng.choice(letters, n))

    terms = [word(rng.integers(1, 10)) for _ in range(60)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(4000):
        w = list(terms[rng.integers(60)])
        for _ in range(rng.integers(0, 4)):
            at = rng.integers(1, len(w) + 1)
            w[at: at + rng.integers(0, 2)] = list(rng.choice(letters, rng.integers(0, 2)))
        w = "".join(w)
        near = [(distance(t[1:], w[1:]), t) for t in set(terms)]
        near = [(d, t) for d, t in near if d <= toxicity.edits_allowed(t)]
        assert lexicon.match(w) == (min(near)[::-1] if near else None), w


def test_context():
    lexicon = toxicity.Lexicon(["moron", "worthless"])
    found, n = toxicity.hits('He wrote "you moron" once. You mooron, worthles moron!', lexicon)
    assert [(f[2], f[3], f[4]) for f in found] == [
        ("moron", 0, True), ("moron", 1, False), ("worthless", 1, False), ("moron", 0, False)]
    assert n == 9 and all(f[5] >= 2 for f in found)


@pytest.mark.parametrize("text,quoted", [
    ("She said hello. You moron!", False),
    ("She said you moron", True),
    ('She wrote "fine" to the moron', False),
    ('"' + "and so on " * 60 + 'moron ' + "and so on " * 60 + '" she said', True),
    ('an open "quotation\nmoron" here', False),
    ("„du moron“ und moron", [True, False]),
    ("«quel moron» puis moron", [True, False]),
    ("‘that moron’ wasn’t a moron", [True, False]),
    ('"a" moron "b" moron', False),
    ('he replied: what a moron', True),
])
def test_quotations(text, quoted):
    found, _ = toxicity.hits(text, toxicity.Lexicon(["moron"]))
    assert [f[4] for f in found] == (quoted if isinstance(quoted, list) else [quoted] * text.count("moron"))


def test_terms_left_out_are_left_out_misspelled_too():
    lexicon = toxicity.Lexicon(["worthless"])
    part = toxicity._part("worthless")
    for word in ("worthless", "worthles", "w0rthless", "wortlhess"):
        assert len(toxicity.hits(f"so {word} then", lexicon, part)[0]) == 0
        assert len(toxicity.hits(f"so {word} then", lexicon, (part + 1) % 4)[0]) == 1


def test_repeated_labelled_ids_are_one_row(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "b"), (None, "c")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in (1, 2, None)], "doc_id long, quality int")
    rows = training_rows(docs, labels, "quality", 10)
    assert sorted(r.doc_id for r in rows.collect()) == sorted(
        r.doc_id for r in labels.filter("doc_id is not null").filter(remainder("doc_id", 3) != 1).collect())


def test_quoted_and_fixed_phrases_stay_in_the_lexicon(spark):
    rng = np.random.default_rng(7)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te", "su") for b in ("ran", "vel", "dol", "pin", "gas")]

    def some(n):
        return " ".join(rng.choice(plain, n))

    rows = []
    for i in range(900):
        kind, word = i % 9, ("zarnok", "glibbet")[i // 9 % 2]
        if kind < 2:  # meant, one of them always after the same word
            rows.append((i, f"{some(8)} {'you zarnok' if word == 'zarnok' else word} {some(8)}", 1))
        elif kind == 2:  # a third of their documents quote them
            rows.append((i, f'{some(8)} "{some(1)} {word} {some(1)}" {some(8)}', 0))
        else:
            rows.append((i, some(18) + (" you" if kind == 3 else ""), 0))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert {t for t in model.value[0].term if t} == {"zarnok", "glibbet"}
    got = {r.doc_id: r for r in toxicity.scored(docs, model).collect()}
    assert all(got[i].predicted == y for i, _, y in rows if got[i].held_out)


def test_edits_anywhere_against_distances():
    rng = np.random.default_rng(5)
    letters = np.array(list("abcdé*_"))
    terms = ["".join(rng.choice(letters[:5], rng.integers(2, 12))) for _ in range(60)]
    lexicon = toxicity.Lexicon(terms)
    for _ in range(4000):
        w = list(terms[rng.integers(60)])
        for _ in range(rng.integers(0, 4)):
            at = rng.integers(0, len(w) + 1)
            w[at: at + rng.integers(0, 2)] = list(rng.choice(letters, rng.integers(0, 2)))
        w = "".join(w)
        near = [(d, t) for t in set(terms) if (d := distance(t, w)) <= toxicity.edits_allowed(t)]
        assert lexicon.match(w) == (min(near)[::-1] if near else None), w


@pytest.mark.parametrize("word,term", [
    ("diot", "idiot"), ("xdiot", "idiot"), ("xidiot", "idiot"), ("*diot", "idiot"), ("id*ot", "idiot"),
    ("st_pid", "stupid"), ("m@ron", "moron"), ("you:m@ron,", "moron"), ("sc*m", "scum"), ("mo-ron", "moron"),
    ("scum", "scum"), ("scvm", None), ("id**t", None)])
def test_misspelled(word, term):
    lexicon = toxicity.Lexicon(["idiot", "stupid", "moron", "scum"])
    found, n = toxicity.hits(f"they are {word} then", lexicon)
    assert [f[2] for f in found] == ([term] if term else [])


def test_short_terms_need_company():
    lexicon = toxicity.Lexicon(["idiot", "scum", "dumb"])
    assert [f[2:4] for f in toxicity.hits("an idiot and scvm", lexicon)[0]] == [("idiot", 0), ("scum", 1)]
    assert toxicity.hits("the sum of a dum scam", lexicon)[0] == []
    assert [f[2:4] for f in toxicity.hits("idiot.id*ot " + "a." * 30000, lexicon)[0]] == [("idiot", 0), ("idiot", 1)]

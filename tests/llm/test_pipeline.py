"""Every stage on a small corpus with planted cases, each against a plain version of its rule."""

import random
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from linkledger.llm import quality
from tests.llm import plain

DATA = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with more planted rows."""
    out = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select(*COLUMNS)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = docs.unionByName(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(*COLUMNS).filter("doc_id >= 200 and doc_id < 420"))
    rows = [r for r in docs.collect()]
    rng = random.Random(2)
    good = [r for r in rows if len(r.text or "") > 400][:6]
    item = spark.read.parquet(f"{DATA}/benchmark.parquet").first().text
    extra = []
    for i, r in enumerate(good):
        w = r.text.split(" ")
        w[rng.randrange(len(w))] = "changed"
        extra.append((9000 + i, " ".join(w), r.lang, r.source, 1))
    extra += [(9100, good[0].text[:300] + " " + item + " end", "en", "s", 1), (9101, None, None, None, None),
              (None, good[1].text, "en", "s", 2), (9102, "mail a.b@c.org or +49 30 123456789 now", "en", "s", 38),
              (9103, "", "en", "s", 0), (9103, "", "en", "s", 0)]
    extra += [tuple(good[2])] * 2
    spark.createDataFrame(rows + extra, docs.schema).repartition(4).write.parquet(f"{out}/documents.parquet")
    labels.write.parquet(f"{out}/labels.parquet")
    spark.read.parquet(f"{DATA}/benchmark.parquet").write.parquet(f"{out}/benchmark.parquet")
    return out


def test_stages(spark, folder):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near duplicates", "decontamination", "personal data", "packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    before, frames = docs, []
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, before, folder).cache())
        before = frames[-1]
    assert all(f.columns == COLUMNS for f in frames[:-1])
    rows = [Counter(map(tuple, f.collect())) for f in [docs, *frames]]

    weights = quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    assert rows[1] == Counter({r: n for r, n in rows[0].items() if quality._scores([r[1]], weights)[0] >= 0.5})
    assert 0.7 < rows[1].total() / rows[0].total() < 1

    kept = plain.one_of_each_group(list(rows[1].elements()))
    assert rows[2] == Counter(kept) and rows[2].total() < rows[1].total() - 5

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert rows[3] == Counter({r: n for r, n in rows[2].items() if not plain.contaminated(r[1], items)})
    assert rows[3].total() < rows[2].total()

    masked = {r[0]: r for r in rows[4]}
    assert rows[4].total() == rows[3].total()
    assert masked[9102][1] == "mail [EMAIL] or [PHONE] now" and masked[9102][4] == len(masked[9102][1])
    for r in rows[3]:
        if not plain.base_spans(r[1] or "") and "://" not in (r[1] or ""):
            assert r in rows[4]

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for r, n in rows[4].items():
        want[r[0]] += n * (len(t.encode(r[1] or "", add_special_tokens=False).ids) + 1)
    got = Counter()
    for r in frames[4].collect():
        got[r.doc_id] += r.length
    assert got == want


def test_run_and_empty(spark, folder, tmp_path):
    done = corpus_pipeline.run(spark, folder)
    assert done.count() > 100 and set(done.columns) >= {"doc_id", "piece", "length", "sequence_id", "offset"}
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

"""Importance resampling towards a target distribution, with an exact cutoff.

1. **Weights.** Word n-grams of the corpus and of a target are counted in hashed buckets. A bucket's gain is the
   logarithm of its share in the target over its share in the corpus, in whole thousandths; a document's weight is the
   sum of the gains of its n-grams, one lookup in an array. The buckets of a text are made once and written as numbers.
2. **Draw.** The weight plus a Gumbel number made from the document's id is its score, and the highest scores are
   drawn: a sample without replacement in proportion to the weights, which any rerun repeats.
3. **Cutoff.** The exact last key that is drawn is found by weighted median-of-medians selection. Every task takes the
   medians of runs of its remaining keys; the median of these, weighted by the sizes of the runs, is the pivot. At least
   about a quarter of the keys lies on each side of it, so a round discards a guaranteed fraction. The same pass that
   counts the keys on both sides of a pivot takes the medians of both sides for the next round. Medians that are too
   many for the driver are narrowed by medians of medians. A bounded rest of keys is sorted in the end.
4. Only the **winners** are sorted, by ranges of their keys.

A null text has no words: weight 0, and it is never drawn. A null id counts as the text ``null`` for its number and
comes last among ties. Repeated rows are drawn each; rows alike in score and id rank in the order in which they were
written. A very long text is read whole. Without documents there are no rows; with an empty target all gains come from
the corpus alone. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from linkledger.llm.common import ROWS_AT_ONCE, Stages, tree_sum
from linkledger.operators.ranking import in_global_order

#: Everything but letters, digits and bytes of other scripts parts words; A-Z become lower case.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CACHE_WORDS = 400_000
#: Keys in a run of which a task takes the median, medians that may reach the driver, and keys that it sorts at last.
RUN, MEDIANS, REST = 1 << 18, 4096, 4096


@dataclass(frozen=True)
class Draw:
    buckets: int = 10_000
    longest: int = 1
    #: Words that a document must have to be drawn.
    least_words: int = 20
    percent: int = 10
    seed: str = "2024"


class _Buckets(dict):
    """Buckets of n-grams seen lately."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        value = self[feature] = zlib.crc32(feature) % self.buckets
        return value


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_BYTES).split()


def bucketed(docs: DataFrame, draw: Draw) -> DataFrame:
    """doc_id, n_words and buckets (of every n-gram, repeats included; as 32-bit numbers) of all rows."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        known = _Buckets(draw.buckets)
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            n_words, found = [], []
            for text in batch.column("text").to_pylist():
                own = words(text)
                n_words.append(len(own))
                grams = own
                for size in range(2, draw.longest + 1):
                    grams = grams + [b" ".join(own[i: i + size]) for i in range(len(own) - size + 1)]
                found.append(np.fromiter(map(known.__getitem__, grams), "<u4", len(grams)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(found, pa.binary())],
                ["doc_id", "n_words", "buckets"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, buckets binary")


def counts(rows: DataFrame, draw: Draw, stages: Stages, name: str) -> np.ndarray:
    """N-grams per bucket, and of all buckets as the last number."""
    def run(batches):
        for batch in batches:
            for held in batch.column(0):
                at = np.frombuffer(held.as_buffer(), "<u4")
                if len(at):
                    yield np.bincount(at, minlength=draw.buckets), len(at)

    return tree_sum(rows.select("buckets"), run, draw.buckets + 1, stages, name)


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths per bucket."""
    n = len(corpus) - 1
    total, wanted = corpus[-1] + n, target[-1] + n
    return np.array([math.floor(1000 * math.log((t + 1) * total / ((s + 1) * wanted)))
                     for s, t in zip(corpus[:-1].tolist(), target[:-1].tolist())], np.int64)


def gumbel(seed: str, doc_id) -> int:
    """A number from the id alone, in whole thousandths."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(rows: DataFrame, gain: np.ndarray, draw: Draw) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of rows with buckets."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = rows.sparkSession.sparkContext.broadcast(gain)

    def run(batches):
        for batch in batches:
            own = [np.frombuffer(b.as_buffer(), "<u4") for b in batch.column("buckets")]
            weight = np.array([held.value[at].sum() for at in own], np.int64)
            luck = np.array([gumbel(draw.seed, i) for i in batch.column("doc_id").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array([len(at) for at in own], pa.int64()),
                 pa.array(weight), pa.array(weight + luck)], ["doc_id", "n_words", "n_features", "weight", "score"])

    return rows.select("doc_id", "n_words", "buckets").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_features long, weight long, score long")


#: The order of keys: the highest score first, then the smaller id, null ids last, then the row's number.
ORDER = [("score", "descending"), ("doc_id", "ascending"), ("row", "ascending")]


def _ahead(key: dict) -> Column:
    """Whether a row's key comes before ``key``."""
    score, own, row = F.col("score"), F.col("doc_id"), F.col("row")
    if key["doc_id"] is None:
        earlier, same = own.isNotNull(), own.isNull()
    else:
        earlier, same = F.coalesce(own < F.lit(key["doc_id"]), F.lit(False)), own.eqNullSafe(F.lit(key["doc_id"]))
    return (score > key["score"]) | ((score == key["score"]) & (earlier | (same & (row < key["row"]))))


def _is(key: dict) -> Column:
    return (F.col("score") == key["score"]) & F.col("doc_id").eqNullSafe(F.lit(key["doc_id"])) & (F.col("row") == key["row"])


def medians(keys: DataFrame, run_keys: int = RUN) -> DataFrame:
    """Of keys (side, score, doc_id, row, weight): per side and run of keys the weighted median, with the weight of the
    run. A run is what a task gets, up to ``run_keys`` rows at a time."""
    def of(run: pa.Table):
        run = run.take(pc.sort_indices(run, sort_keys=ORDER, null_placement="at_end"))
        weight = np.cumsum(run.column("weight").to_numpy())
        middle = run.slice(int(np.searchsorted(weight, (weight[-1] + 1) // 2)), 1)
        return middle.set_column(middle.schema.get_field_index("weight"), "weight", pa.array([int(weight[-1])]))

    def run(batches):
        held, n = [], 0

        def flush():
            rows = pa.Table.from_batches(held)
            for side in pc.unique(rows.column("side")).to_pylist():
                yield from of(rows.filter(pc.equal(rows.column("side"), side))).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= run_keys:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return keys.mapInArrow(run, keys.schema)


def _sort_key(key: dict):
    return -key["score"], key["doc_id"] is None, key["doc_id"] if key["doc_id"] is not None else 0, key["row"]


def cutoff(keys: DataFrame, k: int, stages: Stages, run_keys: int = RUN, most: int = MEDIANS, rest: int = REST) -> dict:
    """The k-th key (from 1) of a written table (score, doc_id, row), by weighted median-of-medians selection."""
    left = keys.select("score", "doc_id", "row")
    remaining, written, pivot, level = left.count(), None, None, 0
    if not 0 < k <= remaining:
        raise ValueError(f"no key {k} of {remaining}")
    while remaining > rest:
        level += 1
        side = F.lit(1) if pivot is None else F.when(_ahead(pivot), 1).when(_is(pivot), 0).otherwise(-1)
        sided = left.select(side.alias("side"), "score", "doc_id", "row", F.lit(1).cast("long").alias("weight"))
        found = stages.write(medians(sided, run_keys), f"medians-{level}")
        sizes = {r.side: r.n for r in found.groupBy("side").agg(F.sum("weight").alias("n")).collect()}
        if pivot is None:
            chosen = 1
        else:
            ahead = sizes.get(1, 0)
            if k == ahead + 1:
                return pivot
            chosen = 1 if k <= ahead else -1
            left = left.filter(_ahead(pivot) if chosen == 1 else ~(_ahead(pivot) | _is(pivot)))
            k -= 0 if chosen == 1 else ahead + 1
            remaining = sizes[chosen]
            # Each table of survivors is a fraction of the one before.
            left, last = stages.write(left, f"left-{level}"), written
            written = f"left-{level}"
            if last:
                stages.drop(last)
        found = found.filter(F.col("side") == chosen)
        narrowed = 0
        while (n := found.count()) > most:
            narrowed += 1
            found = stages.write(medians(found.coalesce(max(1, n // most)), most), f"medians-{level}-{narrowed}")
        middle = sorted((r.asDict() for r in found.collect()), key=_sort_key)
        total = sum(r["weight"] for r in middle)
        pivot = next(r for r, w in zip(middle, np.cumsum([r["weight"] for r in middle])) if 2 * w >= total)
    return sorted((r.asDict() for r in left.collect()), key=_sort_key)[k - 1]


def resampled(docs: DataFrame, target: DataFrame, draw: Draw = Draw(), stages: Stages | None = None) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every row of ``docs`` (doc_id, text), for a
    target of rows with a ``text``."""
    stages = stages or Stages(docs.sparkSession, "resampling")
    rows = stages.write(bucketed(docs, draw), "bucketed")
    wanted = stages.write(bucketed(target.selectExpr("cast(null as long) as doc_id", "text"), draw), "target")
    gain = gains(counts(rows, draw, stages, "corpus-counts"), counts(wanted, draw, stages, "target-counts"))
    scored = stages.write(
        weighed(rows, gain, draw).withColumn("row", F.monotonically_increasing_id()), "scored")
    stages.drop("bucketed")
    stages.drop("target")
    out = ["doc_id", "n_features", "weight", "score"]
    fit = F.col("n_words") >= draw.least_words
    k = scored.filter(fit).count() * draw.percent // 100
    if not k:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    last = cutoff(scored.filter(fit), k, stages)
    drawn = fit & (_ahead(last) | _is(last))
    ranked = in_global_order(
        scored.filter(drawn), ["score DESC", "if(doc_id is null, 1, 0)", "doc_id", "row"], stages.write)
    return ranked.select(*out, F.col("position").cast("long").alias("rank")).unionByName(
        scored.filter(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))

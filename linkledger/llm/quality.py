"""Quality of texts by logistic regression on hashed word n-grams.

A text is split at white space. Its features are one- and two-word sequences of words, and one- to three-word
sequences of word shapes (case, digits and the marks around a word), and two- and three-word sequences of which only
counts where a word is said again at once. Each is hashed to one of 2**18 weights; values
are square roots of shares, so that a score does not grow with the length of a text. The weights are trained with
follow-the-regularised-leader updates on a bounded sample of labelled documents, and a score is a sparse dot product.

A null text counts as empty: it has no feature but the constant one. Empty tables give no rows; without labels all
scores are 0.5. Repeated rows are scored alike, very long texts read whole. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import Stages, claimed, with_columns
from linkledger.llm.ftrl import Ftrl, probability, train
from linkledger.llm.labelled import remainder, training_rows

MODEL = Ftrl(dims=1 << 18)
#: Labelled documents to learn from at most.
SAMPLE = 12_000
THRESHOLD = 0.5
_CACHE_WORDS = 200_000


def shape(word: str) -> str:
    """Marks around a word as they are (three at most on a side), and the kind of what is between them."""
    start, end = 0, len(word)
    while start < end and not word[start].isalnum():
        start += 1
    while end > start and not word[end - 1].isalnum():
        end -= 1
    core = word[start:end]
    if not core:
        return word[:3]
    kind = ("0" if core.isdigit() else "x" if core.islower() else "XX" if core.isupper() and len(core) > 1 else
            "Xx" if core[1:].islower() or len(core) == 1 else "m")
    return f"{word[:start][-3:]}{kind}{word[end:][:3]}"


class _Words(dict):
    """Row numbers of words, and per row the hashes of the word in lower case and of its shape."""

    def __init__(self):
        super().__init__()
        self.hashes = np.zeros((_CACHE_WORDS, 2), np.uint64)

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        self.hashes[row] = (xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "replace"), 1),
                            xxhash.xxh3_64_intdigest(shape(word).encode("utf-8", "replace"), 2))
        return row

    def of(self, words: list[str]) -> np.ndarray:
        out = []
        for i in range(0, len(words), 50_000):
            if len(self) > _CACHE_WORDS - 50_000:
                self.clear()
            part = words[i: i + 50_000]
            out.append(self.hashes[np.fromiter(map(self.__getitem__, part), np.int64, len(part))])
        return np.concatenate(out) if out else np.empty((0, 2), np.uint64)


_words = _Words()
_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers without repeats, and their values; number 0 is the constant."""
    h = claimed(_words).of((text or "").split())
    again = h[1:, 0] == h[:-1, 0]
    views = []
    for view, of, longest in ((0, h[:, 0], 2), (1, h[:, 1], 3), (2, again.astype(np.uint64), 2)):
        for size in range(1, longest + 1):
            if len(of) >= size:
                grams = np.full(len(of) - size + 1, 4 * view + size, np.uint64)
                for i in range(size):
                    grams += of[i: len(of) - size + 1 + i] * _STEPS[i]
                at = ((grams ^ (grams >> np.uint64(31))) * _STEPS[0] >> np.uint64(46)).astype(np.int64)
                found, counts = np.unique(at, return_counts=True)
                views.append((found, np.sqrt(counts / len(grams))))
    at = np.concatenate([[0], *(a for a, _ in views)]).astype(np.int64)
    value = np.concatenate([[1.0], *(v for _, v in views)])
    found, where = np.unique(at, return_inverse=True)
    return found, np.bincount(where, value)


def fit(docs: DataFrame, labels: DataFrame, stages: Stages | None = None):
    """Weights as a broadcast array, from the training fold."""
    stages = stages or Stages(docs.sparkSession, "quality")

    def make(texts):
        found = [features(t) for t in texts]
        return [a.astype(np.int32) for a, _ in found], [v.astype(np.float32) for _, v in found]

    rows = with_columns(training_rows(docs, labels, "quality", SAMPLE), "text", make, "at array<int>, value array<float>")
    rows = stages.write(rows.select("label", "pick", "at", "value"), "examples")
    weights = train(rows, MODEL, stages)
    stages.drop("examples")
    return docs.sparkSession.sparkContext.broadcast(weights)


def _scores(texts, weights) -> list[float]:
    out = []
    for text in texts:
        at, value = features(text)
        out.append(float(probability(weights.value[at].astype(np.float64) @ value)))
    return out


def scored(docs: DataFrame, weights) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    rows = with_columns(docs.select("doc_id", "text"), "text", lambda ts: [_scores(ts, weights)], "score double")
    return rows.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, weights) -> DataFrame:
    """Rows of ``docs``, all columns, whose text scores as good."""
    name = "quality_score"
    while name in docs.columns:
        name += "_"
    rows = with_columns(docs, "text", lambda ts: [_scores(ts, weights)], f"{name} double")
    return rows.filter(F.col(name) >= THRESHOLD).drop(name)

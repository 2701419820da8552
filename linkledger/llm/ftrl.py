"""Logistic regression on sparse features, trained with follow-the-regularised-leader updates.

Examples are dealt to a fixed number of shards. In a round every shard runs the updates over its examples, one or
more times, from the common state and returns what it changed. For the sums of gradients, changes are averaged over the
shards that made one; for the squared ones they are added. State and changes have one entry per feature, so the driver
holds a fixed size.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import Stages, tree_sum


@dataclass(frozen=True)
class Ftrl:
    dims: int
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    rounds: int = 4
    shards: int = 8
    passes: int = 1

    def weights(self, z: np.ndarray, n: np.ndarray) -> np.ndarray:
        shrunk = z - np.sign(z) * self.l1
        return np.where(np.abs(z) <= self.l1, 0.0, -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, z: np.ndarray, n: np.ndarray, label: int, at: np.ndarray, value: np.ndarray) -> None:
        """One update in place; ``at`` has no repeats."""
        w = self.weights(z[at], n[at])
        g = (probability(w @ value) - label) * value
        moved = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / self.alpha
        z[at] += g - moved * w
        n[at] += g * g


def probability(logit):
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def train(examples: DataFrame, model: Ftrl, stages: Stages | None = None, name: str = "change") -> np.ndarray:
    """Weights from a written table (label int, at array<int>, value array<float>, pick long); ``pick`` deals and orders
    its rows. Without rows all weights are 0.

    Every shard's changes are arrays of a fixed size, which a tree of sums adds; the driver gets the sums alone."""
    stages = stages or Stages(examples.sparkSession, "ftrl")
    dealt = examples.withColumn("shard", F.pmod("pick", F.lit(model.shards))).repartition(model.shards, "shard")
    z, n = np.zeros(model.dims), np.zeros(model.dims)
    spark = examples.sparkSession
    for number in range(model.rounds):
        state = spark.sparkContext.broadcast((z, n))

        def run(batches):
            held = list(batches)
            if not held:
                return
            z0, n0 = state.value
            for _, own in pa.Table.from_batches(held).to_pandas().groupby("shard"):
                z1, n1 = z0.copy(), n0.copy()
                found = [(r.label, np.asarray(r.at, np.int64), np.asarray(r.value, np.float64))
                         for r in own.sort_values("pick").itertuples()]
                for label, at, value in found * model.passes:
                    model.learn(z1, n1, label, at, value)
                yield np.concatenate([z1 - z0, n1 - n0, (z1 != z0) | (n1 != n0)]), 1

        total = tree_sum(dealt, run, 3 * model.dims + 1, stages, f"{name}-{number}")
        dz, dn, moved = total[:-1].reshape(3, model.dims)
        z += dz / np.maximum(moved, 1)
        n += dn
        state.destroy()
    return model.weights(z, n).astype(np.float32)

"""Exact top-k by inner product with MaxScore over sparse integer postings.

A vector is a document whose terms are (dimension, sign) pairs; its impact on a term is the size of the component.
A query has the term of every component that is not 0: documents with the same sign in that dimension gain, those with
the other sign lose, so the gains alone bound a score from above.

Candidates are dealt to shards of bounded size by a hash of their id, and every query meets every shard. A shard builds
its postings once, with the largest impact of each term in each block of documents, and answers one query after the
other with MaxScore. Documents are traversed in blocks, in the order of their ids:

* the terms are ordered by their bound in the block (query weight times largest impact), and the longest run of small
  terms that cannot beat the threshold together is non-essential;
* documents of the block are found in postings of essential terms only; all terms are then probed, the largest bound
  first, with gains and losses, while the partial score plus the remaining bounds still beats the threshold;
* what is left has its whole score, and the threshold rises to the k-th best score so far. A later document needs more
  than that, as equal scores go to the smaller id; so the split moves on from block to block.

Shards send k rows per query, and a ranking over those rows merges them. Bounds are exact integers, so the result is
that of a full comparison: highest scores first, ties to the smaller id.

Vectors that are null, or hold a null or a component that is not finite, take no part; nor do rows without an id. A
shorter vector counts as having zeros at its end. Repeated rows of one id are separate candidates, and none of them
is a candidate of a query with that id; a repeated query id is answered once, for its smallest vector. Empty tables give
no rows. Other columns play no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Rows of a candidate shard, about, and documents of a block. They bound the memory of a task, not the result.
SHARD_ROWS = 8192
BLOCK_ROWS = 512
#: Terms that are probed together.
PROBES = 8
RESULT = "query_id long, vec_id long, score long"


class Shard:
    """Postings of one shard: per (dimension, sign) the rows in order, and the largest impact in every block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, block_rows: int = BLOCK_ROWS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        # The first blocks are small, so that a threshold is found early.
        edges, size = [0], min(64, block_rows)
        while edges[-1] < len(ids):
            edges.append(min(len(ids), edges[-1] + size))
            size = min(block_rows, 2 * size)
        self.edges = np.array(edges)
        self.postings, self.starts, self.largest = {}, {}, {}
        for d in range(vectors.shape[1]):
            column = self.vectors[:, d]
            for sign in (1, -1):
                rows = np.flatnonzero(column * sign > 0)
                impact = np.zeros(len(column), np.int64)
                impact[rows] = column[rows] * sign
                self.postings[d, sign] = rows
                self.starts[d, sign] = np.searchsorted(rows, self.edges)
                self.largest[d, sign] = np.maximum.reduceat(impact, self.edges[:-1]) if len(rows) else np.zeros(
                    len(self.edges) - 1, np.int64)
        #: Documents whose whole score was made, for all queries.
        self.scored = 0

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best documents but ``own``."""
        width = min(len(query), self.vectors.shape[1])
        dims = np.flatnonzero(query[:width])
        weight = np.abs(query[dims])
        signs = np.where(query[dims] > 0, 1, -1).tolist()
        terms = list(zip(dims.tolist(), signs))
        bounds = np.stack([w * self.largest[t] for w, t in zip(weight, terms)]) if terms else np.zeros(
            (0, len(self.edges) - 1), np.int64)
        rows, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for block, (start, end) in enumerate(zip(self.edges[:-1].tolist(), self.edges[1:].tolist())):
            threshold = int(scores[-1]) if len(scores) == k else None
            order = np.argsort(-bounds[:, block], kind="stable")
            #: rest[i]: what the terms from i on can give at most
            rest = np.append(np.cumsum(bounds[order, block][::-1])[::-1], 0)
            if threshold is None or threshold < 0:
                alive = np.arange(start, end)  # documents without any gain can be among the best
            else:
                seen = np.zeros(end - start, bool)
                for i in order[: np.count_nonzero(rest[:-1] > threshold)].tolist():
                    first = self.starts[terms[i]]
                    seen[self.postings[terms[i]][first[block]: first[block + 1]] - start] = True
                    if seen.all():
                        break
                alive = np.flatnonzero(seen) + start
            alive = alive[self.ids[alive] != own]
            score = np.zeros(len(alive), np.int64)
            for at in range(0, len(order), PROBES):
                probed = dims[order[at: at + PROBES]]
                score += self.vectors[alive[:, None], probed] @ query[probed]
                if threshold is not None:
                    able = score + rest[min(at + PROBES, len(order))] > threshold
                    alive, score = alive[able], score[able]
                    if not len(alive):
                        break
            self.scored += len(alive)
            rows, scores = np.concatenate([rows, alive]), np.concatenate([scores, score])
            best = np.lexsort((rows, -scores))[:k]
            rows, scores = rows[best], scores[best]
        return self.ids[rows], scores


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def integer_vectors(table: DataFrame, vector: str, scale: int) -> DataFrame:
    """vec_id and v: floor(scale * component) as integers, of complete and finite vectors."""
    x = F.col(vector).cast("array<double>")
    sound = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    return table.select("vec_id", x.alias("x")).filter(F.col("vec_id").isNotNull() & sound).select(
        "vec_id", F.transform(F.col("x"), lambda e: F.floor(F.lit(float(scale)) * e)).alias("v"))


def search(candidates: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = SHARD_ROWS,
           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score of the k best candidates of every query. Both inputs have vec_id and v."""
    shards = max(1, -(-candidates.count() // shard_rows))
    held = candidates.select(
        F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), F.lit(0).alias("asks"), "vec_id", "v")
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v")).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("asks"), "vec_id", "v")
    # A shard's candidates come first, then its queries, one batch after the other.
    dealt = held.unionByName(asked).repartition(shards, "shard").sortWithinPartitions("shard", "asks")

    def matrix(rows: pa.Table, width: int) -> np.ndarray:
        return _matrix(rows.column("v").to_pylist(), width)

    def answer(batches):
        number, waiting, shard = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = 2 * table.column("shard").to_numpy().astype(np.int64) + table.column("asks").to_numpy()
            edges = np.flatnonzero(np.diff(keys, prepend=-1, append=-1))
            for a, b in zip(edges, edges[1:]):
                part, own, asks = table.slice(a, b - a), int(keys[a]) // 2, int(keys[a]) % 2
                if own != number:
                    number, waiting, shard = own, [], None
                if not asks:
                    waiting.append(part)
                    continue
                if shard is None:
                    if not waiting:
                        continue
                    rows = pa.concat_tables(waiting)
                    width = max(map(len, rows.column("v").to_pylist()))
                    shard, waiting = Shard(rows.column("vec_id").to_numpy(), matrix(rows, width), block_rows), []
                for query_id, query in zip(part.column("vec_id").to_pylist(), part.column("v").to_pylist()):
                    ids, scores = shard.search(np.array(query, np.int64), query_id, k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(ids), query_id)), pa.array(ids), pa.array(scores)],
                        ["query_id", "vec_id", "score"])

    best = dealt.mapInArrow(answer, RESULT)
    # Merge of the shards: k rows of each per query.
    return best.selectExpr(
        "query_id",
        "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank", "vec_id", "score",
    ).filter(F.col("rank") <= k)

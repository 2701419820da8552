"""Jaccard join of documents on word shingles, by size-banded tiles with hashed bitmap signatures.

1. ``signatures``: each text becomes a set of shingle hashes. Kept of it: its size, a 64-bit key of the set, a bitmap
   and its prefix. Documents with one key are copies and form one node from here on.
2. The prefix of a set are its (1 - t) * n + 1 shingles that come first in one order of all shingles; two sets that
   link share a shingle of their prefixes. Rare shingles come first, by a table of counters over all texts, so a
   passage that very many documents share is hardly ever in a prefix. The order only steers the cost: any table of
   counters gives the same links.
3. A tile holds the nodes of a shared prefix shingle that lie in one size band or its neighbour; sets that link
   differ in size by a factor of t at most. Tiles with the same members are one tile. Shingles whose counter is high may
   be in very many prefixes: their members are counted with partial sums and joined back, so none is one task's rows.
4. In a tile, the bitmap of a node has as many bits as its band asks for, each shingle toggling one. The bits in which
   two bitmaps differ are at most the shingles in which the sets differ, which bounds the overlap from above. Pairs
   below the bound are dropped without a look at their shingles.
5. The other pairs are settled by intersecting their sorted shingle arrays, which are made again from the texts:
   hashing is cheap, and arrays of all texts would fill more disk than the texts do.

Tiles are worked in three passes. The first compares each node with one leader of its tile, which joins most members
of a large group of near copies. The second compares bitmaps, in blocks, of all pairs that are not in one component
yet, and settles for each node the nearest of every other component. The third does the same and settles all pairs
that are still open, so no link between components is lost, and a large group is not compared with itself. Blocks are
of bounded size, and a tile of any size is spread over many tasks. Each pass joins the components of the one before.

Null and empty texts have an empty set and no link. Repeated rows are copies. Rows without an id count as copies and
get the smallest id of their group, or null. A very long text is hashed whole, a stretch at a time. An empty table gives
no rows. Other columns play no part.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import Stages, tree_sum, with_columns
from linkledger.llm.components import components, joined
from linkledger.llm.shingles import shingle_set

THRESHOLD = Fraction(3, 4)
#: Counters for the order of shingles; the counter from which a shingle's members are counted with partial sums.
COUNTERS, FREQUENT = 1 << 20, 5_000
#: Bits of a bitmap per shingle, at least.
SPARSE = 2
#: Nodes in a block of a tile, and rows of a block whose pairs are taken by their distance in it.
BLOCK, SMALL = 2048, 96
#: Rows of tiles that one task compares, about.
TASK_ROWS = 20_000
#: Rows of one or two keys of 8 bytes that may be broadcast to a scan of the texts (32 MB at most); beyond that, texts
#: are shuffled.
BROADCAST_KEYS = 2_000_000
#: Words of bitmaps that are compared at one time.
_WORDS_AT_ONCE = 1 << 21


def shingle_order(docs: DataFrame, stages: Stages):
    """Counters over the shingles of all texts, as a broadcast array of fixed size."""
    def run(batches):
        for batch in batches:
            sets = [shingle_set(text.as_py()) for text in batch.column(0)]
            s = np.concatenate(sets) if sets else np.empty(0, np.uint64)
            if len(s):
                yield np.bincount((s & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS), 0

    total = tree_sum(docs.select("text"), run, COUNTERS + 1, stages, "counts")
    return docs.sparkSession.sparkContext.broadcast(np.minimum(total[:-1], 65535).astype(np.uint16))


def band(n: int) -> int:
    """Sets that link lie in one band or in neighbouring bands: a band spans a factor of 1 / t in size."""
    return int(math.log(n) / math.log(1 / THRESHOLD) + 1e-9)


def bitmap_bits(band_number: int) -> int:
    """Bits per bitmap: at least SPARSE times the size of the largest set in the band after it, from 64 to 65536. The
    more bits, the fewer shingles share one, and the fewer pairs just below the threshold stay open."""
    largest = SPARSE * float(1 / THRESHOLD) ** (band_number + 2)
    return 1 << min(16, max(6, math.ceil(math.log2(largest))))


def bitmap(shingles: np.ndarray, bits: int) -> np.ndarray:
    """Words of a bitmap in which every shingle toggles a bit."""
    odd = np.bincount((shingles >> np.uint64(40)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    """A row of bitmaps of fewer bits: those of a larger one laid over each other. Differences only shrink."""
    while words.shape[-1] * 64 > bits:
        half = words.shape[-1] // 2
        words = words[..., :half] ^ words[..., half:]
    return words


def set_key(shingles: np.ndarray) -> int | None:
    """One number per set, as a signed 64-bit value; null for the empty set."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2 ** 63 if len(shingles) else None


def signatures(docs: DataFrame, order) -> DataFrame:
    """doc_id, text_hash, n, key, bits (a bitmap), prefix and rare (how many of the prefix are not frequent; they come
    first) of every document; key is null for empty sets. Copies that meet in a batch have bits and prefix once."""
    frequent = FREQUENT

    def make(texts):
        out, seen = [], set()
        for text in texts:
            s = shingle_set(text)
            key = set_key(s)
            if key is None or key in seen:
                out.append((len(s), key, None, None, None))
                continue
            seen.add(key)
            counts = order.value[(s & np.uint64(COUNTERS - 1)).astype(np.int64)]
            first = np.argsort(counts, kind="stable")[: len(s) - math.ceil(THRESHOLD * len(s)) + 1]
            out.append((len(s), key, bitmap(s, bitmap_bits(band(len(s)))).tobytes(), s[first].view(np.int64),
                        int((counts[first] < frequent).sum())))
        return list(zip(*out)) or [[]] * 5

    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return with_columns(
        keyed, "text", make, "n long, key long, bits binary, prefix array<long>, rare int").drop("text")


def tiles(signed: DataFrame) -> DataFrame:
    """(tile, band, key, n, top) of tiles with two members or more, from signatures; ``top`` marks members of the tile's
    own band. Those of the band below meet each other in their own tile."""
    held = signed.filter("prefix is not null")
    banded = f"cast(floor(ln(n) / ln({float(1 / THRESHOLD)}) + 1e-9) as int) as band"
    # A node comes once per batch that holds a copy of it.
    rare = held.selectExpr("key", "n", "explode(slice(prefix, 1, rare)) as token").repartition("token").groupBy(
        "token", "key").agg(F.first("n").alias("n")).selectExpr(
        "key", "n", "count(*) over (partition by token) as members",
        "bit_xor(xxhash64(key)) over (partition by token) as mark").filter("members > 1")
    often = held.selectExpr("key", "n", "explode(slice(prefix, rare + 1, size(prefix))) as token").distinct()
    counted = often.groupBy("token").agg(
        F.count("*").alias("members"), F.expr("bit_xor(xxhash64(key))").alias("mark")).filter("members > 1")
    shared = rare.select("key", "n", "members", "mark").unionByName(
        often.join(counted, "token").select("key", "n", "members", "mark"))
    own = shared.selectExpr("xxhash64(mark, members) as members", "key", "n", banded).distinct()
    # Each node is in the tile of its band and in that of the band above, where it meets larger sets.
    return own.selectExpr("members", "key", "n", "band as own", "explode(array(band, band + 1)) as band").selectExpr(
        "xxhash64(members, band) as tile", "band", "key", "n", "own = band as top")


def most_apart(nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Shingles in which two sets that link can differ: x + y - 2 * least overlap, in integers."""
    p, q = THRESHOLD.numerator, THRESHOLD.denominator
    total = nx + ny
    return total - 2 * -(-(p * total) // (p + q))


class _Block:
    """Rows of units of one band, with bitmaps of one width, in the order of their units."""

    def __init__(self, rows: pd.DataFrame, bits: int):
        rows = rows.sort_values("unit", kind="stable")
        self.unit, self.key, self.n, self.component, self.side, self.top = (
            rows[c].to_numpy() for c in ("unit", "key", "n", "component", "side", "top"))
        self.words = np.stack([folded(np.frombuffer(b, np.uint64), bits) for b in rows["bits"]])

    def open_pairs(self, i: np.ndarray, j: np.ndarray):
        """Which pairs sizes and bitmaps leave open, and in how many bits they differ."""
        p, q = THRESHOLD.numerator, THRESHOLD.denominator
        able = ((self.side[i] != self.side[j]) & (self.component[i] != self.component[j]) & (self.top[i] | self.top[j])
                & (p * np.maximum(self.n[i], self.n[j]) <= q * np.minimum(self.n[i], self.n[j])))
        i, j = i[able], j[able]
        apart = np.empty(len(i), np.int64)
        step = max(1, _WORDS_AT_ONCE // self.words.shape[1])
        for a in range(0, len(i), step):
            part = slice(a, a + step)
            apart[part] = np.bitwise_count(self.words[i[part]] ^ self.words[j[part]]).sum(axis=1, dtype=np.int64)
        near = apart <= most_apart(self.n[i], self.n[j])
        return i[near], j[near], apart[near]

    def pairs(self):
        """Open pairs (left row, right row, bits apart) of all units, part by part."""
        begin = np.flatnonzero(np.concatenate([[True], self.unit[1:] != self.unit[:-1]]))
        size = np.diff(np.append(begin, len(self.unit)))
        at = np.flatnonzero(np.repeat(size <= SMALL, size))
        step = 1
        while len(at):
            at = at[at + step < len(self.unit)]
            at = at[self.unit[at] == self.unit[at + step]]
            yield self._sided(*self.open_pairs(at, at + step))
            step += 1
        for start, n in zip(begin[size > SMALL].tolist(), size[size > SMALL].tolist()):
            own = np.arange(start, start + n)
            left, right = own[self.side[own] == 1], own[self.side[own] == 0]
            for i in left.tolist():
                yield self._sided(*self.open_pairs(np.full(len(right), i), right))

    def _sided(self, i, j, apart):
        swap = self.side[i] == 0
        return np.where(swap, j, i), np.where(swap, i, j), apart


def _compare(rows: pd.DataFrame, nearest: bool) -> pd.DataFrame:
    """Open pairs of the tile blocks in ``rows``: those of the left side (1) with all of the right (0) of another
    component; with ``nearest``, only the one per component of the right side whose bitmap differs least."""
    xs, ys = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for number, of_band in rows.groupby("band", sort=False):
        # Members of a tile are of its band or the one below; the narrower bitmaps decide.
        block = _Block(of_band, bitmap_bits(int(number) - 1))
        found = [np.concatenate(x) for x in zip(*block.pairs())] or [np.empty(0, np.int64)] * 3
        i, j, apart = found
        if nearest and len(i):
            order = np.lexsort((block.key[j], apart, block.component[j], i))
            i, j = i[order], j[order]
            first = np.concatenate([[True], (i[1:] != i[:-1]) | (block.component[j[1:]] != block.component[j[:-1]])])
            i, j = i[first], j[first]
        xs.append(np.minimum(block.key[i], block.key[j]))
        ys.append(np.maximum(block.key[i], block.key[j]))
    return pd.DataFrame({"x": np.concatenate(xs), "y": np.concatenate(ys)}).drop_duplicates()


def _across(parts: DataFrame, nodes: DataFrame, stages: Stages, name: str, nearest: bool) -> DataFrame:
    """Open pairs (x, y) across components, of tiles whose members have a ``component``.

    Members outside a tile's largest component meet all members, in blocks."""
    per = parts.groupBy("tile", "component").agg(F.count("*").alias("held"), F.max("top").alias("top"))
    sizes = per.groupBy("tile").agg(
        F.max(F.struct("held", "component"))["component"].alias("major"), F.sum("held").alias("size"),
        F.max("held").alias("major_size"), F.count("*").alias("components"), F.max("top").alias("any_top"),
    ).filter("components > 1 and any_top").selectExpr(
        "tile", "major", f"cast(ceil(size / {BLOCK}) as int) as blocks",
        f"cast(ceil((size - major_size) / {BLOCK}) as int) as minor_blocks")
    rows = parts.join(sizes, "tile")
    fields = ["tile", "band", "key", "n", "top", "component"]
    right = rows.selectExpr(
        *fields, "0 as side", "cast(pmod(xxhash64(key), blocks) as int) as block",
        "explode(sequence(0, minor_blocks - 1)) as minor")
    left = rows.filter("component <> major").selectExpr(
        *fields, "1 as side", "explode(sequence(0, blocks - 1)) as block",
        "cast(pmod(xxhash64(key, 1), minor_blocks) as int) as minor")
    sided = stages.write(right.unionByName(left).selectExpr(
        "xxhash64(tile, block, minor) as unit", *fields[1:], "side"), f"{name}-sided")
    tasks = max(1, sided.count() // TASK_ROWS)
    dealt = sided.join(nodes.select("key", "bits"), "key").withColumn("task", F.pmod(F.xxhash64("unit"), F.lit(tasks)))

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        return _compare(rows, nearest)

    return dealt.groupBy("task").applyInPandas(compare, "x long, y long").distinct()


def shingle_arrays(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(key, shingles) of the nodes in a written table (key, text_hash), made again from a text of each."""
    if wanted.count() <= BROADCAST_KEYS:
        wanted = F.broadcast(wanted)
    texts = docs.select("text", F.xxhash64("text").alias("text_hash")).join(wanted, "text_hash").select("key", "text")

    def make(values):
        out, seen = [], set()
        for text in values:
            s = shingle_set(text)
            key = set_key(s)
            out.append((None if key in seen else s.view(np.int64), key))
            seen.add(key)
        return list(zip(*out)) or [[]] * 2

    made = with_columns(texts, "text", make, "shingles array<long>, own long")
    return made.filter("own = key and shingles is not null").groupBy("key").agg(F.first("shingles").alias("shingles"))


def _verified(pairs: DataFrame, arrays: DataFrame) -> DataFrame:
    """Pairs that link, by intersecting sorted arrays."""
    p, q = THRESHOLD.numerator, THRESHOLD.denominator
    both = pairs.join(arrays.selectExpr("key as x", "shingles as xs"), "x").join(
        arrays.selectExpr("key as y", "shingles as ys"), "y")

    def check(batches):
        for batch in batches:
            keep = []
            for xs, ys in zip(batch.column("xs"), batch.column("ys")):
                xs, ys = (v.values.to_numpy(zero_copy_only=False).view(np.uint64) for v in (xs, ys))
                common = len(np.intersect1d(xs, ys, assume_unique=True))
                keep.append(q * common >= p * (len(xs) + len(ys) - common))
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("x"), kept.column("y")], ["a", "b"])

    return both.mapInArrow(check, "a long, b long")


def linked_nodes(docs: DataFrame, signed: DataFrame, stages: Stages) -> DataFrame:
    """(node, component, first) of all nodes of a written table of ``signatures``; ``first`` is the smallest id."""
    nodes = stages.write(
        signed.filter("key is not null").groupBy("key").agg(
            F.min("doc_id").alias("first"), F.min("text_hash").alias("text_hash"), F.first("n").alias("n"),
            F.first("bits", True).alias("bits")), "nodes")
    tiled = stages.write(tiles(signed), "tiles")

    # First pass: each node of a tile with the tile's leader.
    leaders = tiled.groupBy("tile").agg(
        F.min(F.struct(F.xxhash64("key").alias("h"), "key")).alias("leader"), F.count("*").alias("members"))
    leaders = leaders.filter("members > 1").selectExpr("tile", "leader.key as lead")
    stars = tiled.join(leaders, "tile").filter("key <> lead")
    pairs = _bounded(stars.selectExpr("least(key, lead) as x", "greatest(key, lead) as y").distinct(), nodes)
    links = stages.write(_settled(pairs, docs, nodes, stages, "star"), "links-0")
    labels = nodes.selectExpr("key as node").join(components(links, stages, "parts"), "node", "left").selectExpr(
        "node", "coalesce(component, node) as component")
    labels = stages.write(labels, "labels-0")

    # Then across components: each node with the nearest of another component, and at last with all that are open.
    for number, nearest in enumerate((True, False), 1):
        parts = stages.write(tiled.join(labels.withColumnRenamed("node", "key"), "key"), f"parted-{number}")
        open_ = _across(parts, nodes, stages, f"pass-{number}", nearest)
        more = stages.write(_settled(open_, docs, nodes, stages, f"pass-{number}"), f"links-{number}")
        labels = stages.write(joined(labels, more, stages, f"join-{number}"), f"labels-{number}")
        stages.drop(f"parted-{number}")
    return labels.join(nodes.selectExpr("key as node", "first"), "node")


def _settled(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, stages: Stages, name: str) -> DataFrame:
    """Links among open pairs."""
    pairs = stages.write(pairs, f"{name}-pairs")
    ends = pairs.select(F.col("x").alias("key")).union(pairs.select("y")).distinct()
    wanted = stages.write(ends.join(nodes.select("key", "text_hash"), "key"), f"{name}-wanted")
    arrays = stages.write(shingle_arrays(docs, wanted), f"{name}-arrays")
    links = stages.write(_verified(pairs, arrays), f"{name}-links")
    stages.drop(f"{name}-arrays")
    return links


def _bounded(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (x, y) whose sizes and bitmaps allow a link."""
    pairs = pairs.join(nodes.selectExpr("key as x", "n as nx", "bits as bx"), "x").join(
        nodes.selectExpr("key as y", "n as ny", "bits as by"), "y")

    def check(batches):
        p, q = THRESHOLD.numerator, THRESHOLD.denominator
        for batch in batches:
            nx, ny = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("nx", "ny"))
            keep = p * np.maximum(nx, ny) <= q * np.minimum(nx, ny)
            most = most_apart(nx, ny)
            bx, by = batch.column("bx"), batch.column("by")
            for i in np.flatnonzero(keep):
                a, b = (np.frombuffer(v[int(i)].as_buffer(), np.uint64) for v in (bx, by))
                bits = 64 * min(len(a), len(b))
                keep[i] = np.bitwise_count(folded(a, bits) ^ folded(b, bits)).sum() <= most[i]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column("x"), kept.column("y")], ["x", "y"])

    return pairs.mapInArrow(check, "x long, y long")


def grouped(docs: DataFrame, stages: Stages | None = None) -> DataFrame:
    """doc_id, text_hash, n, and component (a number per group, null for empty sets) and least (its smallest id) of
    every row of ``docs`` (doc_id, text)."""
    stages = stages or Stages(docs.sparkSession, "ngram-join")
    order = shingle_order(docs, stages)
    signed = stages.write(signatures(docs, order), "signed")
    named = linked_nodes(docs, signed, stages)
    least = named.groupBy("component").agg(F.min("first").alias("least"))
    named = named.join(least, "component").selectExpr("node as key", "component", "least")
    return signed.select("doc_id", "text_hash", "n", "key").join(named, "key", "left").drop("key")


def near_groups(docs: DataFrame, stages: Stages | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    return grouped(docs, stages).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each_group(docs: DataFrame, stages: Stages | None = None) -> DataFrame:
    """Rows of ``docs``, all columns, of which one stays per group: that of the smallest id, of one id the text of the
    smallest hash, of repeated rows one. Rows with an empty set all stay."""
    stages = stages or Stages(docs.sparkSession, "ngram-join")
    rows = stages.write(grouped(docs, stages).filter("component is not null"), "grouped")
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    best = rows.groupBy("component").agg(F.min(place).alias("best"))
    own = rows.groupBy("component", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    own = own.join(best, "component").withColumn("stays", place == F.col("best"))
    name = F.xxhash64("doc_id", "text_hash").alias("row_hash")
    gone = stages.write(own.filter("not stays").select(name), "gone")
    again = stages.write(own.filter("stays and copies > 1").select(name), "again")

    def meets(other: DataFrame):
        return F.xxhash64(docs["doc_id"], F.xxhash64(docs["text"])) == other["row_hash"]

    def sized(other: DataFrame) -> DataFrame:
        return F.broadcast(other) if other.count() <= BROADCAST_KEYS else other

    left = docs.join(sized(gone), meets(gone), "left_anti")
    if again.isEmpty():
        return left
    once = left.join(sized(again), meets(again), "left_anti")
    repeated = left.join(sized(again), meets(again), "left_semi")
    return once.unionByName(repeated.dropDuplicates(["doc_id", "text"]))

"""Near copies by SimHash fingerprints, found with multi-index hashing.

1. **Fingerprint.** A bit is 1 if it is set in over half of the XXH64 values of a text's word shingles, repeats
   included. Rows of one fingerprint are one node from here on, so copies cost nothing more.
2. **Index.** The 64 bits are cut into segments. Of two fingerprints with at most DISTANCE different bits, some segment
   differs in no more bits than its radius, if the radii add up to DISTANCE - segments + 1. Every node stands in a
   bucket for its value of each segment, and probes the buckets of the values in the Hamming ball around it. Of two
   values that differ, the one whose lowest different bit is 0 probes the other, so a pair meets once per segment.
3. **Verification.** Members of a bucket are compared by their whole fingerprints, in numpy. A bucket beyond BLOCK
   members is cut into blocks, and each pair of blocks is a unit of its own, so a bucket of any size is spread over
   many tasks and none is held whole. Pairs that link come out as a forest for large units: links that only repeat
   what others connect are left out, and no component loses a member.
4. **Components** of the links, by rounds over written tables.

A null text counts as empty. Texts without words have the fingerprint zero, and link like any other. A text of fewer
words than a shingle has is one shingle; a very long one is hashed whole, in parts. Repeated rows are copies. Rows
without an id get the smallest id of their component, or null. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import Stages, with_columns
from linkledger.llm.components import components
from linkledger.llm.shingles import words

WORDS, SEED, DISTANCE, BITS = 4, 42, 4, 64
SEGMENTS = 3
#: Members of a unit's side at most, and of a run whose pairs are all listed.
BLOCK, SMALL = 8192, 64
#: Hashes whose bits are counted at one time.
_PART = 1 << 15


def fingerprint(text: str | None, width: int = WORDS) -> int:
    """The fingerprint as an unsigned number."""
    own = words(text) if text else []
    if not own:
        return 0
    width = min(width, len(own))
    joined = b" ".join(own)
    ends = np.cumsum(np.fromiter(map(len, own), np.int64, len(own)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = len(own) - width + 1
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _PART):
        spans = zip(starts[at: min(at + _PART, n)].tolist(), ends[at + width - 1: at + width - 1 + _PART].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8)).reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view("<u8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint (signed) of every row."""
    def make(texts):
        return [np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64)]

    return with_columns(docs.select("doc_id", "text"), "text", make, "fingerprint long").drop("text")


def plan(distance: int = DISTANCE, segments: int = SEGMENTS) -> list[tuple[int, int, int]]:
    """(first bit, bits, radius) of the segments that are searched."""
    cuts = [BITS * i // segments for i in range(segments + 1)]
    least, more = divmod(distance + 1, segments)
    radii = [least - 1 + (i < more) for i in range(segments)]
    return [(a, b - a, r) for a, b, r in zip(cuts, cuts[1:], radii) if r >= 0]


def placed(nodes: DataFrame, distance: int = DISTANCE, segments: int = SEGMENTS) -> DataFrame:
    """(bucket, fingerprint, stands) of every node's own buckets, and of those that it probes."""
    searched = plan(distance, segments)
    balls = [[sum(1 << b for b in held) for size in range(1, radius + 1)
              for held in itertools.combinations(range(width), size)] for _, width, radius in searched]

    def run(batches):
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for number, ((first, width, _), masks) in enumerate(zip(searched, balls)):
                value = own >> np.uint64(first) & np.uint64((1 << width) - 1)
                for mask in [0, *masks]:
                    probes = np.flatnonzero(value & np.uint64(mask & -mask) == 0) if mask else slice(None)
                    bucket = (value[probes] ^ np.uint64(mask)) * np.uint64(len(searched)) + np.uint64(number)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(bucket.view(np.int64)), pa.array(own[probes].view(np.int64)),
                         pa.array(np.full(len(bucket), not mask))], ["bucket", "fingerprint", "stands"])

    return nodes.select("fingerprint").mapInArrow(run, "bucket long, fingerprint long, stands boolean")


def units(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """(unit, fingerprint, stands, side): buckets of up to ``block`` members are a unit; of larger ones each pair of
    blocks is, with the blocks as sides 1 and 2 (0: compared among each other)."""
    large = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter(f"n > {block}").selectExpr(
        "bucket", f"cast(ceil(n / {block}) as int) as blocks")
    held = rows.join(large, "bucket", "left")
    small = held.filter("blocks is null").selectExpr("bucket as unit", "fingerprint", "stands", "0 as side")
    dealt = held.filter("blocks is not null").selectExpr(
        "*", "cast(pmod(xxhash64(fingerprint, 7), blocks) as int) as own",
    ).selectExpr("*", "explode(sequence(0, blocks - 1)) as other")
    split = dealt.selectExpr(
        "xxhash64(bucket, least(own, other), greatest(own, other)) as unit", "fingerprint", "stands",
        "case when own = other then 0 when own < other then 1 else 2 end as side")
    return small.unionByName(split)


def _listed(unit, own, stands, distance):
    """Links inside runs of few members: all pairs, by their distance within the run."""
    at = np.arange(len(unit))
    step = 1
    while True:
        at = at[at + step < len(unit)]
        at = at[unit[at + step] == unit[at]]
        if not len(at):
            return
        near = (stands[at] | stands[at + step]) & (
            np.bitwise_count(own[at] ^ own[at + step]) <= distance) & (own[at] != own[at + step])
        yield own[at[near]], own[at[near] + step]
        step += 1


def _forest(own, stands, side, distance):
    """Links inside one large unit that connect all that link in it."""
    label = np.arange(len(own))
    for i in range(len(own)):
        if side[i] == 2:
            continue
        others = np.flatnonzero(side == 2) if side[i] == 1 else np.arange(i + 1, len(own))
        if not stands[i]:
            others = others[stands[others]]
        near = others[np.bitwise_count(own[others] ^ own[i]) <= distance]
        near = near[label[near] != label[i]]
        if len(near):
            known, first = np.unique(label[near], return_index=True)
            first = near[first]
            yield np.full(len(first), own[i]), own[first]
            label[np.isin(label, known)] = label[i]


def links(dealt: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b) of fingerprints that link, from rows of ``units``; a forest where units are large."""
    ordered = dealt.repartition("unit").sortWithinPartitions("unit")

    def settled(unit, own, stands, side):
        starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(unit)]]))
        few = np.repeat((sizes <= SMALL), sizes) & (side == 0)
        yield from _listed(unit[few], own[few], stands[few], distance)
        for start in np.unique(np.repeat(starts, sizes)[~few]):
            part = slice(start, start + sizes[np.searchsorted(starts, start)])
            yield from _forest(own[part], stands[part], side[part], distance)

    def run(batches):
        rest = None
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                new = [batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64),
                       batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy()]
                rest = new if rest is None else [np.concatenate(pair) for pair in zip(rest, new)]
            if rest is None or not len(rest[0]):
                continue
            # The last unit may go on in the next batch.
            end = len(rest[0]) if batch is None else int(np.searchsorted(rest[0], rest[0][-1]))
            whole, rest = [c[:end] for c in rest], [c[end:] for c in rest]
            if end:
                for a, b in settled(*whole):
                    if len(a):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.minimum(a, b).view(np.int64)), pa.array(np.maximum(a, b).view(np.int64))],
                            ["a", "b"])

    return ordered.mapInArrow(run, "a long, b long").distinct()


def near_groups(docs: DataFrame, stages: Stages | None = None) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``docs`` (doc_id, text)."""
    stages = stages or Stages(docs.sparkSession, "simhash")
    signed = stages.write(fingerprints(docs), "fingerprints")
    nodes = stages.write(signed.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "nodes")
    rows = stages.write(placed(nodes), "placed")
    found = stages.write(links(units(rows)), "links")
    stages.drop("placed")
    labels = components(found, stages, "parts").withColumnRenamed("node", "fingerprint")
    named = nodes.join(labels, "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("component", "fingerprint").alias("component"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    named = stages.write(named.join(least, "component").select("fingerprint", "component_id"), "named")
    return signed.join(named, "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")

"""Best-fit packing of tokenised documents after Martello-Toth dominance reduction.

Documents become pieces of at most CAPACITY tokens. Pieces of one length are alike, so the packing is planned on the
number of pieces per length, a table of CAPACITY rows whatever the size of the corpus:

1. **Reduction.** From the longest piece on, a sequence is fixed for good when a small set with that piece dominates
   every other set that holds it: the piece alone when nothing else fits; with its exact complement; with the longest
   piece that fits when no two fit, or when that piece is as long as any two that fit and no three do.
2. **Best fit.** What is left is packed by best fit, longest first. Alike sequences are kept as one group with a
   number of members.

The plan says for every length which ranks go to which sequences. A piece's rank among those of its length is its
number within its part of the table plus the pieces of earlier parts, so ranks are made without a common sort.

A null text is an empty one: its only token is the end mark. Rows without an id are packed like any other; repeated
rows are packed each. A very long text is encoded whole and cut into pieces. An empty table gives no pieces. Other
columns play no part.
"""

from __future__ import annotations

import bisect
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import ROWS_AT_ONCE, Stages, claimed
from linkledger.llm.tokens import as_numbers, encoder

CAPACITY = 2048
END = 0
_END = END.to_bytes(4, "little")


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, part and place (number among pieces of its length in its part), and
    with ``keep_ids`` the ids. A document that is too long is cut so that only its first piece is shorter."""
    schema = "piece int, start long, length long, ids_crc32 long, part long, place long"
    if keep_ids:
        schema += ", ids array<int>"

    def cut(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = defaultdict(int)
        encode = claimed(encoder(tokenizer)).encode_bytes
        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            rows, made = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text or "") + _END
                n = len(ids) // 4
                start, end = 0, n - (n - 1) // capacity * capacity
                for piece in range(1 + (n - end) // capacity):
                    own = ids[4 * start: 4 * end]
                    length = end - start
                    rows.append(row)
                    made.append((piece, start, length, zlib.crc32(own), part, seen[length],
                                 as_numbers(own).astype(np.int32) if keep_ids else None))
                    seen[length] += 1
                    start, end = end, end + capacity
            kinds = [pa.int32(), *[pa.int64()] * 5] + [pa.list_(pa.int32())] * keep_ids
            columns = list(zip(*made)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())),
                 *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "place"] + ["ids"] * keep_ids)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut, f"doc_id {kind}, {schema}")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Groups of alike sequences, as (number of sequences, [(length, pieces of it per sequence), ...])."""
    left = {n: c for n, c in counts.items() if c}
    fixed = _reduce(left, capacity)
    return fixed + _best_fit(left, capacity)


def _reduce(left: dict[int, int], capacity: int):
    """Fix dominating sets and take them out of ``left``."""
    fixed = []

    def take(times: int, *lengths: int):
        fixed.append((times, [(n, lengths.count(n)) for n in dict.fromkeys(lengths)]))
        for n in lengths:
            left[n] -= times
            if not left[n]:
                del left[n]

    changed = True
    while changed:
        changed = False
        for n in sorted(left, reverse=True):
            while left.get(n):
                choice = _dominating(left, n, capacity)
                if choice is None:
                    break
                changed = True
                if choice == ():
                    take(left[n], n)
                else:
                    k = choice[0]
                    take(left[n] // 2 if k == n else min(left[n], left[k]), n, k)
    return fixed


def _dominating(left: dict[int, int], n: int, capacity: int):
    """What belongs to a piece of length n: () for nothing, (k,) for one piece, None if no small set dominates."""
    room = capacity - n
    lengths = np.array(sorted(k for k in left if k <= room and (k != n or left[n] > 1)), np.int64)
    if not len(lengths):
        return ()
    largest = int(lengths[-1])
    if largest == room:
        return (largest,)
    number = [left[int(k)] - (k == n) for k in lengths[:3]]
    smallest = [int(k) for k, c in zip(lengths[:3], number) for _ in range(min(c, 3))][:3]
    if len(smallest) < 2 or sum(smallest[:2]) > room:
        return (largest,)
    if len(smallest) > 2 and sum(smallest) <= room:
        return None
    partner = np.searchsorted(lengths, room - lengths, "right") - 1
    fits = partner >= 0
    pairs = lengths[fits] + lengths[partner[fits]]
    return (largest,) if largest >= pairs.max(initial=0) else None


def _best_fit(left: dict[int, int], capacity: int):
    """Best fit, longest first, of all pieces in ``left``."""
    groups: dict[int, list[tuple[int, list]]] = defaultdict(list)
    rooms: list[int] = []  # rooms of open groups, in order

    def put(room: int, times: int, held: list):
        if not times:
            return
        if room not in groups or not groups[room]:
            bisect.insort(rooms, room)
        groups[room].append((times, held))

    for n in sorted(left, reverse=True):
        count = left[n]
        while count:
            at = bisect.bisect_left(rooms, n)
            if at < len(rooms):
                room = rooms[at]
                times, held = groups[room].pop()
                if not groups[room]:
                    del rooms[at]
            else:
                room, times, held = capacity, -(-count // (capacity // n)), []
            each = room // n
            full = min(times, count // each)
            put(room - each * n, full, held + [(n, each)])
            count -= full * each
            if full < times:
                if count:
                    put(room - count * n, 1, held + [(n, count)])
                    put(room, times - full - 1, held)
                    count = 0
                else:
                    put(room, times - full, held)
    return [group for of_room in groups.values() for group in of_room if group[1]]


def slots(groups) -> dict[str, np.ndarray]:
    """The plan by length and rank: pieces of a length from a rank on go to sequences from a number on, some to each,
    from an offset on."""
    rows, rank, sequence = [], defaultdict(int), 0
    for times, held in groups:
        offset = 0
        for n, each in held:
            rows.append((n, rank[n], sequence, each, offset))
            rank[n] += times * each
            offset += n * each
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "each", "offset"), table.T))


def place(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with sequence_id and offset. ``cut`` is a written table of ``pieces``."""
    per_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    before = per_part.selectExpr(
        "part", "length",
        "coalesce(sum(n) over (partition by length order by part rows between unbounded preceding and 1 preceding), 0)"
        " as earlier")
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = cut.sparkSession.sparkContext.broadcast(slots(plan(counts, capacity)))
    ranked = cut.join(before, ["part", "length"]).withColumn("rank", F.col("place") + F.col("earlier"))
    ranked = ranked.drop("part", "place", "earlier")

    def assign(batches):
        t = table.value
        step = 1 << 40
        keys = t["length"] * step + t["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length * step + rank, "right") - 1
            nth = rank - t["rank"][at]
            sequence = t["sequence"][at] + nth // t["each"][at]
            offset = t["offset"][at] + nth % t["each"][at] * length
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                names + ["sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(assign, f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, keep_ids: bool = False,
           stages: Stages | None = None) -> DataFrame:
    """All pieces of ``docs`` with their places."""
    stages = stages or Stages(docs.sparkSession, "packing")
    cut = stages.write(pieces(docs, tokenizer, capacity, keep_ids), "pieces")
    out = place(cut, capacity)
    order = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return out.select(*order, *["ids"] * keep_ids)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids and doc_ids of every sequence, of pieces that kept their ids."""
    held = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
    return held.select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"))

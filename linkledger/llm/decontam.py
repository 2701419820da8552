"""Benchmark decontamination with suffix arrays over the training texts.

A shard of training texts becomes a sequence of word numbers in which only words of the benchmark have a number of
their own. Stretches too short for any window are left out, and the suffixes of the rest are sorted. Every suffix of
every benchmark item is binary-searched in that array, word by word, until its window is whole; the range that is
left holds all its places in the shard. Places of neighbouring suffixes on one diagonal join to the longest verbatim
match there. Shards are batches of rows, searched where they are read; nothing is shuffled.

A window is WINDOW consecutive words of an item; an item of fewer words, but not none, is one window. A document word
inside any place of any window is hit, and a document with a hit is contaminated.

The benchmark is broadcast in blocks of at most BLOCK_WORDS words. One block is usual; with more, the texts pass
through one search per block and the hits are united, so the benchmark may have any size.

Null and empty texts have no words and hit nothing. Items without an id hit words like any other, but are not named;
repeated items count once. Repeated documents are each matched, very long ones whole. An empty benchmark leaves
everything clean, and an empty table gives no rows. Other columns pass through.
"""

from __future__ import annotations

import hashlib
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import with_columns

WINDOW = 10
#: Words of the benchmark in one broadcast.
BLOCK_WORDS = 2_000_000

#: Word characters stay, A-Z in lower case; other characters of ASCII separate words.
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


class Block:
    """Items of the benchmark as word numbers, all suffixes that begin a window, and the vocabulary."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [i for i, _ in items]
        numbers, item, place, size = [], [], [], []
        for k, (_, ws) in enumerate(items):
            w = min(window, len(ws))
            for start in range(len(ws) - w + 1):
                item.append(k)
                place.append(len(numbers) + start)
                size.append(w)
            numbers += [self.vocabulary.setdefault(word, len(self.vocabulary) + 1) for word in ws]
        self.numbers = np.array(numbers + [0] * window, np.int64)
        self.item, self.place, self.size = (np.array(v, np.int64) for v in (item, place, size))
        self.shortest = int(self.size.min(initial=window))

    def search(self, text: np.ndarray):
        """(window number, place in ``text``) of every occurrence of every window; ``text`` holds word numbers, 0
        for other words and ends of documents."""
        none = np.empty(0, np.int64)
        if not len(self.item) or not len(text):
            return none, none
        # Only stretches of benchmark words that are long enough can hold a window.
        known = np.flatnonzero(np.diff(np.concatenate([[0], (text > 0).astype(np.int8), [0]])))
        begins, ends = known[::2], known[1::2]
        long = ends - begins >= self.shortest
        begins, ends = begins[long], ends[long]
        if not len(begins):
            return none, none
        lengths = ends - begins + 1
        at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths - begins, lengths)
        short = np.where(at < np.repeat(ends, lengths), text[np.minimum(at, len(text) - 1)], 0)
        suffixes = suffix_array(short, int(self.size.max()))
        padded = np.append(short, np.zeros(int(self.size.max()), np.int64))
        low = np.zeros(len(self.item), np.int64)
        high = np.full(len(self.item), len(suffixes))
        for depth in range(int(self.size.max())):
            live = np.flatnonzero((low < high) & (depth < self.size))
            if not len(live):
                break
            wanted = self.numbers[self.place[live] + depth]
            column = padded[suffixes + depth]
            low[live], high[live] = (_bound(column, low[live], high[live], wanted, right) for right in (False, True))
        found = high - low
        window = np.repeat(np.arange(len(self.item)), found)
        inside = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found, found)
        return window, at[suffixes[low[window] + inside]]


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` in the order of their next ``depth`` words, by doubling."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64) + 1
    order = np.argsort(rank, kind="stable")
    size = 1
    while size < depth and rank.max(initial=0) < len(text):
        after = np.zeros(len(text), np.int64)
        after[: max(0, len(text) - size)] = rank[size:]
        both = rank * (len(text) + 2) + after
        order = np.argsort(both, kind="stable")
        rank = np.empty(len(text), np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (np.diff(both[order]) != 0).astype(np.int64)]))
        size *= 2
    return order


def _bound(column: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """Per search, the first place in column[low:high] whose value is not below (right: is above) the wanted one."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        value = column[np.minimum(middle, len(column) - 1)]
        up = open_ & ((value <= wanted) if right else (value < wanted))
        low = np.where(up, middle + 1, low)
        high = np.where(open_ & ~up, middle, high)


def _matched(texts: list, block: Block):
    """Per text: number of words, hit intervals [start, end), and the longest match per item as
    (item, start in the item, start in the text, words)."""
    split = [words(t) for t in texts]
    starts = np.cumsum([0] + [len(w) + 1 for w in split])
    sequence = np.zeros(starts[-1], np.int64)
    for start, ws in zip(starts.tolist(), split):
        sequence[start: start + len(ws)] = np.fromiter(map(block.vocabulary.get, ws, repeat(0)), np.int64, len(ws))
    intervals = [[] for _ in texts]
    longest = [{} for _ in texts]
    window, place = block.search(sequence)
    if len(window):
        # Hits of one diagonal of one item, in order: runs of neighbours are one verbatim match.
        item = block.item[window]
        order = np.lexsort((place, place - block.place[window], item))
        item, window, place = item[order], window[order], place[order]
        diagonal = place - block.place[window]
        first = np.flatnonzero(np.concatenate(
            [[True], (np.diff(place) != 1) | (np.diff(diagonal) != 0) | (np.diff(item) != 0)]))
        last = np.append(first[1:], len(place)) - 1
        item_start = np.concatenate([[0], np.flatnonzero(np.diff(block.item)) + 1])
        first_place = dict(zip(block.item[item_start].tolist(), block.place[item_start].tolist()))
        docs = np.searchsorted(starts, place[first], "right") - 1
        for d, k, a, b, w in zip(docs.tolist(), item[first].tolist(), place[first].tolist(), place[last].tolist(),
                                 window[first].tolist()):
            begin, n = a - int(starts[d]), b - a + int(block.size[w])
            intervals[d].append((begin, begin + n))
            known = longest[d].get(k)
            if known is None or n > known[2]:
                longest[d][k] = (int(block.place[w]) - first_place[k], begin, n)
    return [len(w) for w in split], intervals, longest


def _united(intervals) -> list[tuple[int, int]]:
    out = []
    for a, b in sorted(intervals):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS):
    """The benchmark as broadcasts of bounded size."""
    spark = benchmark.sparkSession
    items, held, made = [], 0, []
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").distinct()
    for row in rows.toLocalIterator():
        ws = words(row.text)
        if ws and items and held + len(ws) > block_words:
            made.append(spark.sparkContext.broadcast(Block(items)))
            items, held = [], 0
        if ws:
            items.append((row.item_id, ws))
            held += len(ws)
    if items or not made:
        made.append(spark.sparkContext.broadcast(Block(items)))
    return made


def _free(name: str, df: DataFrame) -> str:
    while name in df.columns:
        name += "_"
    return name


def matches(docs: DataFrame, held: list) -> tuple[DataFrame, str]:
    """All rows and columns of ``docs`` with a struct of n_words, hits (intervals of words) and found (per item its
    longest match); and the name of the struct."""
    schema = ("n_words: bigint, hits: array<struct<start:bigint,end:bigint>>, found: "
              "array<struct<item_id:string,item_start:bigint,start:bigint,words:bigint>>")
    names = []
    out = docs
    for block in held:
        def make(texts, block=block):
            n, intervals, longest = _matched(texts, block.value)
            return [[
                {"n_words": k, "hits": [{"start": a, "end": b} for a, b in spans],
                 "found": [{"item_id": block.value.ids[i], "item_start": s, "start": a, "words": w}
                           for i, (s, a, w) in sorted(found.items())]}
                for k, spans, found in zip(n, intervals, longest)]]

        names.append(_free("matched", out))
        out = with_columns(out, "text", make, f"{names[-1]} struct<{schema}>")
    if len(names) == 1:
        return out, names[0]
    name = _free("matched_all", out)
    whole = F.struct(
        F.col(names[0])["n_words"].alias("n_words"), F.concat(*(F.col(c)["hits"] for c in names)).alias("hits"),
        F.concat(*(F.col(c)["found"] for c in names)).alias("found"))
    return out.withColumn(name, whole).drop(*names), name


def report(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: words, words hit, and the items found in it."""
    rows, name = matches(docs.select("doc_id", "text"), blocks(benchmark, block_words))

    def make(values):
        hit, count, digest = [], [], []
        for v in values:
            hit.append(sum(b - a for a, b in _united((h["start"], h["end"]) for h in v["hits"])))
            ids = sorted({f["item_id"] for f in v["found"] if f["item_id"] is not None})
            count.append(len(ids))
            digest.append(hashlib.sha256(",".join(ids).encode()).hexdigest())
        return hit, count, digest

    rows = with_columns(rows.select("doc_id", name), name, make, "n_hit long, n_items long, items_sha256 string")
    return rows.select("doc_id", F.col(name)["n_words"].alias("n_words"), "n_hit", "n_items", "items_sha256",
                       (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows of ``docs``, all columns, without any hit."""
    rows, name = matches(docs, blocks(benchmark))
    return rows.filter(F.size(F.col(name)["hits"]) == 0).drop(name)

"""Spelling variants of words, found with search schemes on a bidirectional FM-index.

1. **Words** are counted over all texts, in the tasks first. Frequent enough and long enough ones are the vocabulary.
2. **Search.** Of a word and one at a single edit, either the left half or the right half is whole, and stands at the
   same end of both. So a search matches one half exactly up to its delimiter and goes on across the other half with
   one edit; two searches find all. Words that keep a left half share their first letters, and words that keep a right
   half their last ones: the vocabulary is dealt by these, and each unit has an index of its own (``fmindex``). Letters
   that very many words share are cut into blocks, and each block of searches meets each block of words, so an index
   and its searches are of bounded size and no word near is missed.
3. **Forms.** A word's form is the most frequent word near it, if that is FACTOR times as frequent or more. Roots follow
   forms to the last one, by rounds of joins that double their reach; each form is FACTOR times as frequent, so chains
   are short.

A null text has no words. A null id counts as the text ``null`` for the noise. Repeated rows are counted each; a very
long text, or a run of letters of any length, is read whole. An empty table gives no rows. Other columns play no part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import ROWS_AT_ONCE, Stages
from linkledger.llm.fmindex import Index

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Words that a task counts before it passes them on.
_COUNTED = 400_000
#: Words in a block of a unit, and words that a task's index has, about.
BLOCK, TASK_WORDS = 20_000, 30_000


@dataclass(frozen=True)
class Rules:
    least_letters: int = 6
    least_uses: int = 5
    factor: int = 5
    #: One run of letters in so many loses a letter, by a hash of the document and the run; 0: none does.
    noise: int = 199


def word_counts(docs: DataFrame, rules: Rules) -> DataFrame:
    """(word, n) of words of ``docs`` (doc_id, text) that have the least number of letters."""
    def run(batches):
        total: Counter[str] = Counter()

        def made():
            rows = pa.RecordBatch.from_pydict({
                "word": pa.array(list(total), pa.string()), "n": pa.array(list(total.values()), pa.int64())})
            total.clear()
            return rows

        for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                own: Counter[str] = Counter()
                for word, n in Counter(_RUN.findall(text)).items():
                    if len(word) >= rules.least_letters:
                        own[word if word.islower() else word.translate(_LOWER)] += n
                begun = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for word, n in own.items():
                    h = zlib.crc32(word.encode(), begun) if rules.noise else 1
                    if rules.noise and h % rules.noise == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < rules.least_letters:
                            continue
                    total[word] += n
                if len(total) > _COUNTED:
                    yield made()
        if total:
            yield made()

    parts = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def near_words(vocabulary: DataFrame, rules: Rules = Rules(), block: int = BLOCK, task_words: int = TASK_WORDS) -> DataFrame:
    """(word, near, near_n) of all pairs of words at exactly one edit, both ways. ``vocabulary`` (word, n) is a written
    table of words with the least number of letters."""
    piece = rules.least_letters // 2
    if piece < 1:
        raise ValueError("words of one letter have no halves")
    ends = vocabulary.selectExpr(
        "word", "n", f"explode(array(struct(true as left_half, left(word, {piece}) as piece), "
        f"struct(false as left_half, right(word, {piece}) as piece))) as e").select("word", "n", "e.*")
    large = ends.groupBy("left_half", "piece").agg(F.count("*").alias("held")).filter(f"held > {block}").selectExpr(
        "left_half", "piece", f"cast(ceil(held / {block}) as int) as blocks")
    tasks = max(1, 2 * vocabulary.count() // task_words)
    dealt = ends.join(large, ["left_half", "piece"], "left").selectExpr(
        "*", "cast(pmod(xxhash64(word), coalesce(blocks, 1)) as int) as own",
    ).selectExpr("*", "explode(sequence(0, coalesce(blocks, 1) - 1)) as other")
    # Block ``own`` is searched for in block ``other``, and holds what block ``other`` searches.
    sided = dealt.selectExpr(
        "word", "n", "left_half", "explode(if(own = other, array(struct(own as a, own as b, true as asks, true as holds)), "
        "array(struct(own as a, other as b, true as asks, false as holds), "
        "struct(other as a, own as b, false as asks, true as holds)))) as u", "piece",
    ).selectExpr(
        "word", "n", "left_half", "u.asks", "u.holds",
        f"cast(pmod(xxhash64(left_half, piece, u.a, u.b), {tasks}) as int) as task")

    def search(rows: pd.DataFrame) -> pd.DataFrame:
        # Units of one task share an index; what a search meets beyond its own unit is right as well.
        left = bool(rows["left_half"].iloc[0])
        held = rows[rows["holds"]].drop_duplicates("word").sort_values("word")
        asked = rows.loc[rows["asks"], "word"].drop_duplicates()
        query, found = Index(held["word"].tolist()).near(asked.tolist(), left)
        return pd.DataFrame({
            "word": asked.to_numpy()[query], "near": held["word"].to_numpy()[found], "near_n": held["n"].to_numpy()[found]})

    return sided.groupBy("left_half", "task").applyInPandas(
        search, "word string, near string, near_n long").distinct()


def roots(forms: DataFrame, stages: Stages) -> DataFrame:
    """(word, root) of every word with a form, from a written table (word, form)."""
    reached, number = forms.selectExpr("word", "form as root"), 0
    while True:
        number += 1
        ahead = reached.selectExpr("word as root", "root as further")
        after = stages.write(
            reached.join(ahead, "root", "left").selectExpr(
                "word", "coalesce(further, root) as root", "further is not null as moved"), f"roots-{number}")
        if number > 1:
            stages.drop(f"roots-{number - 1}")
        reached = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return reached


def variants(docs: DataFrame, rules: Rules = Rules(), stages: Stages | None = None) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of the vocabulary of ``docs`` (doc_id, text)."""
    stages = stages or Stages(docs.sparkSession, "variants")
    vocabulary = stages.write(word_counts(docs, rules).filter(f"n >= {rules.least_uses}"), "vocabulary")
    # The most frequent first; of these the first in code-point order, which is that of UTF-8 bytes.
    best = near_words(vocabulary, rules).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("fewer"), "near")).alias("best"))
    known = stages.write(
        vocabulary.join(best, "word", "left").withColumn("fits", F.expr(f"-best.fewer >= {rules.factor} * n")).selectExpr(
            "word", "n", "coalesce(n_near, 0) as n_near", "if(fits, best.near, null) as form",
            "if(fits, -best.fewer, null) as form_n"), "known")
    ends = roots(known.filter("form is not null").select("word", "form"), stages)
    return known.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))

"""Toxicity of texts: a learned lexicon, misspellings by Levenshtein automata, and the context of each hit.

* **Lexicon.** From a bounded sample of labelled documents: words that stand in toxic documents again and again, among
  different words, and far more often than they are meant in others. A quotation in a clean document is no evidence
  against a word.
* **Match.** The Levenshtein automata of all terms, intersected with the trie of the lexicon, are one automaton. Its
  states are sets of (trie node, edits); they are built as words need them and kept. It accepts a word within one
  edit of a term of 3 letters or more, two edits from 9 letters on, and names the term and the edits; any letter may be
  wrong, the first one too. A word with marks or underscores inside is also matched whole, marks as letters. An edited
  term under 5 letters counts with marks inside, or if a surer hit stands near.
* **Context.** A window of words around a hit shows whether it is quoted or meant, and how many other hits stand near.
  Quoted is what stands between two quotation marks of its line, however far these are, and what follows a verb of
  saying in its sentence, unless a quotation ends between the two. Hits are counted per class of edits, quotation and
  company.
* **Score.** A logistic model over these counts, trained on the same documents. Terms are left out of their own
  lexicon in a part of the training rows, so that the weights of misspelled and unseen forms are learned too.

A null text counts as empty. Texts without a hit get the score of the constant alone, the lowest. Without toxic
labels, or on an empty table, no lexicon is found and all texts score alike. Repeated rows are scored each. A very long
text is read word by word. Other columns play no part.
"""

from __future__ import annotations

import bisect
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F

from linkledger.llm.common import Stages, with_columns
from linkledger.llm.ftrl import Ftrl, probability, train
from linkledger.llm.labelled import remainder, training_rows

#: Labelled documents to learn from at most.
SAMPLE = 12_000
THRESHOLD = 0.7
#: A term stands in so many toxic documents and in such a share of them, in so many different windows of words (copies
#: of a passage have one); and the smoothed logarithm of its share of toxic documents over its share of clean documents
#: that hold it unquoted is so high.
LEAST_DOCUMENTS, LEAST_SHARE, LEAST_CONTEXTS, LEAST_ODDS = 4, 0.005, 4, 2.0
#: Words on a side of a hit that show how it is meant.
WINDOW = 6
#: Shorter terms need more than an edited word.
SURE = 5
#: Entries of kept states (a node and its edits each) and kept words.
_STATES, _CACHE_WORDS = 2_000_000, 300_000

_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_SPACE = re.compile(r"\s")
#: Verbs that announce a quotation, in the languages of the corpus.
_SAYING = frozenset((
    "said says wrote writes called quoted quote quotes replied term word slur insult reported "
    "sagte schrieb nannte zitat wort zitierte dit écrit appelé citation mot dijo escribió llamó cita palabra").split())
#: What closes a quotation, by the mark that opens it; and where a sentence ends.
_CLOSES = {'"': '"', "“": "”", "„": "“”", "«": "»", "‘": "’"}
_MARK = re.compile(r'["“”„«»‘\n]|’(?![^\W_])')
_STOP = re.compile(r"[.!?…](?:[\s\"”“»’)]|\Z)|\n")

#: Features: the constant, then one per class of hits, then the share of words that are hits.
DIMS = 16
MODEL = Ftrl(dims=DIMS, alpha=0.5, l1=0.001, l2=0.001, rounds=4, passes=15)


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 3 else 1 if len(term) < 9 else 2


class Lexicon:
    """Terms, and the automaton that accepts words near them."""

    def __init__(self, terms):
        self.children, self.term, self.room = [{}], [None], [0]
        for term in sorted(set(terms)):
            node = 0
            for letter in term:
                below = self.children[node].get(letter)
                if below is None:
                    below = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.room.append(0)
                node = below
                self.room[node] = max(self.room[node], edits_allowed(term))
            self.term[node] = term
        self.room[0] = max(self.room)
        #: Letters that a word near a term has at most.
        self.longest = max((len(t) + edits_allowed(t) for t in self.term if t), default=0)
        self._forget()

    def _forget(self):
        self.numbers, self.states, self.moves, self.known, self.unsure, self.held = {}, [], [], {}, set(), 0
        self.start = self._number({0: 0})

    def _number(self, state: dict[int, int]) -> int:
        """The number of a state after letters of terms left out were skipped: per node the fewest edits."""
        todo = list(state)
        while todo:
            node = todo.pop()
            edits = state[node] + 1
            for below in self.children[node].values():
                if edits <= self.room[below] and edits < state.get(below, 99):
                    state[below] = edits
                    todo.append(below)
        key = frozenset(state.items())
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(state)
            self.held += len(state)
            self.moves.append({})
        return number

    def _move(self, number: int, letter: str) -> int:
        after: dict[int, int] = {}

        def reach(node, edits):
            if edits <= self.room[node] and edits < after.get(node, 99):
                after[node] = edits

        for node, edits in self.states[number].items():
            for own, below in self.children[node].items():
                if own == letter:
                    reach(below, edits)
                else:
                    reach(below, edits + 1)  # another letter
            reach(node, edits + 1)  # a letter too many
        return self._number(after) if after else -1

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term and its edits, or None; of equally near terms the first in order. ``unsure`` holds the words
        that are near short terms only, and not equal to them."""
        if word in self.known:
            return self.known[word]
        if self.held > _STATES or len(self.known) > _CACHE_WORDS:
            self._forget()
        at = self.start
        for letter in word:
            move = self.moves[at].get(letter)
            if move is None:
                move = self.moves[at][letter] = self._move(at, letter)
            at = move
            if at < 0:
                break
        found = None
        if at >= 0:
            ends = [(edits, self.term[n]) for n, edits in self.states[at].items()
                    if self.term[n] is not None and edits <= edits_allowed(self.term[n])]
            found = min(ends)[::-1] if ends else None
            if ends and all(edits and len(term) < SURE for edits, term in ends):
                self.unsure.add(word)
        self.known[word] = found
        return found


class Quotations:
    """Stretches of a text between two marks of a line, paired in one pass."""

    def __init__(self, text: str):
        opened: dict[str, int] = {}
        found = []
        for m in _MARK.finditer(text):
            mark, at = m[0], m.start()
            if mark == "\n":
                opened.clear()
                continue
            mine = [o for o in opened if mark in _CLOSES[o]]
            if mine:
                found.append((opened.pop(max(mine, key=opened.get)), at))
            elif mark in _CLOSES:
                opened[mark] = at
        self.text = text
        #: Outermost stretches in order; a text position has at most one that holds it.
        self.starts, self.ends = [], []
        for start, end in sorted(found):
            if not self.ends or start > self.ends[-1]:
                self.starts.append(start)
                self.ends.append(end)
            else:
                self.ends[-1] = max(end, self.ends[-1])

    def hold(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.starts, start) - 1
        return at >= 0 and end <= self.ends[at]

    def end_between(self, start: int, end: int) -> bool:
        at = bisect.bisect_left(self.ends, start)
        return at < len(self.ends) and self.ends[at] < end


def _quoted(quotes: Quotations, start: int, end: int, before: list[tuple[str, int]]) -> bool:
    """Whether a hit stands in a quotation, or after a verb of saying; ``before``: words with the places they end at."""
    if quotes.hold(start, end):
        return True
    said = next((at for word, at in reversed(before) if word in _SAYING), None)
    # The mark after a sentence's last word belongs to the gap, and so does the character after it.
    return (said is not None and not quotes.end_between(said, start)
            and _STOP.search(quotes.text[said:start]) is None)


def hits(text: str | None, lexicon: Lexicon, without: int | None = None) -> tuple[list[tuple], int]:
    """(start, end, term, edits, quoted, company) of every hit, and the number of words.

    ``without``: terms whose hash has this remainder by 4 are not known, for training rows.
    """
    text = text or ""
    found, words, spans = {}, [], []

    def look(at, start, end, marked):
        word = text[start:end].lower()
        match = lexicon.match(word)
        if match and (without is None or _part(match[0]) != without):
            return (at, start, end, *match, marked or word not in lexicon.unsure)
        return None

    def joined(first):
        """Match neighbours from word ``first`` on, with only marks between them, as one where that takes fewer edits."""
        while first < len(spans) - 1:
            best = None
            for last in range(first + 1, len(spans)):
                start, end = spans[first][0], spans[last][1]
                if end - start > lexicon.longest:
                    break
                match = look(first, start, end, True)
                if match and (best is None or match[4] <= best[0][4]):
                    best = match, last
            if best:
                match, last = best
                own = [found[i] for i in range(first, last + 1) if i in found]
                if all(f[4] > match[4] or not f[5] for f in own):
                    for f in own:
                        del found[f[0]]
                    found[first] = match
                    first = last
            first += 1

    first = 0
    for m in _WORD.finditer(text):
        start, end = m.span()
        if spans:
            last = spans[-1][1]
            if start - last == 1 and text[last] == " " or _SPACE.search(text, last, start):
                joined(first)
                first = len(spans)
        match = look(len(words), start, end, False)
        if match:
            found[len(words)] = match
        words.append(m[0].lower())
        spans.append((start, end))
    joined(first)
    found = [found[at] for at in sorted(found)]
    sure = np.array([f[0] for f in found if f[5]], np.int64)

    def near(places, at):
        return int(np.searchsorted(places, at + WINDOW, "right") - np.searchsorted(places, at - WINDOW))

    found = [f for f in found if f[5] or near(sure, f[0])]
    out = []
    places = np.array([f[0] for f in found], np.int64)
    quotes = Quotations(text) if found else None
    for at, start, end, term, edits, _ in found:
        before = [(words[i], spans[i][1]) for i in range(max(0, at - WINDOW), at)]
        out.append((start, end, term, edits, _quoted(quotes, start, end, before), near(places, at) - 1))
    return out, len(words)


def _part(term: str) -> int:
    return sum(term.encode()) % 4


def features(text: str | None, lexicon: Lexicon, without: int | None = None) -> np.ndarray:
    """Values of all features: logarithms of counts of hits by edits, quotation and company."""
    found, n = hits(text, lexicon, without)
    counts = np.zeros(DIMS)
    for _, _, _, edits, quoted, company in found:
        counts[1 + 4 * min(edits, 2) + 2 * quoted + (company > 0)] += 1
    values = np.log1p(counts)
    values[0] = 1
    values[13] = len(found) > 0
    values[14] = 10 * min(0.1, sum(not f[4] for f in found) / max(n, 1))
    values[15] = 10 * min(0.1, sum(f[4] for f in found) / max(n, 1))
    return values


def learn_lexicon(rows: DataFrame) -> list[str]:
    """All terms that training rows (text, label) show; the bound on these rows bounds the terms."""
    def made(texts):
        out = []
        for text in texts:
            places = [(m.start(), m.end()) for m in _WORD.finditer(text or "")]
            words = [text[a:b].lower() for a, b in places]
            seen, meant, quotes = {}, set(), Quotations(text or "")
            for i, (word, (start, end)) in enumerate(zip(words, places)):
                seen.setdefault(word, i)
                if word not in meant:
                    before = [(words[j], places[j][1]) for j in range(max(0, i - WINDOW), i)]
                    if not _quoted(quotes, start, end, before):
                        meant.add(word)
            out.append([
                {"word": w, "around": zlib.crc32(" ".join(words[max(0, i - WINDOW):i + WINDOW + 1]).encode()),
                 "meant": w in meant} for w, i in seen.items()])
        return [out]

    words = with_columns(
        rows.select("label", "text"), "text", made, "seen array<struct<word:string,around:long,meant:boolean>>")
    words = words.select("label", F.explode("seen").alias("s")).select("label", "s.word", "s.around", "s.meant")
    # Windows are counted in two steps, so that a frequent word is not one task's rows.
    per = words.groupBy("word", "around").agg(
        F.sum("label").alias("toxic"), F.count_if(F.expr("label = 0 and meant")).alias("clean"))
    per = per.groupBy("word").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
        F.sum((F.col("toxic") > 0).cast("int")).alias("contexts"))
    n_toxic, n_clean = (rows.filter(f"label = {label}").count() for label in (1, 0))
    least = max(LEAST_DOCUMENTS, LEAST_SHARE * n_toxic)
    per = per.filter(
        f"toxic >= {least} and contexts >= {LEAST_CONTEXTS} and "
        f"ln((toxic + 0.5) / ({n_toxic} + 1)) - ln((clean + 0.5) / ({n_clean} + 1)) >= {LEAST_ODDS}")
    return [r.word for r in per.orderBy("word").select("word").collect()]


def fit(docs: DataFrame, labels: DataFrame, stages: Stages | None = None):
    """(lexicon, weights) as a broadcast, from the training fold."""
    stages = stages or Stages(docs.sparkSession, "toxicity")
    rows = stages.write(training_rows(docs, labels, "toxic", SAMPLE), "sample")
    spark = docs.sparkSession
    terms = spark.sparkContext.broadcast(Lexicon(learn_lexicon(rows)))

    def make(values):
        at, value = [], []
        for i, text in enumerate(values):
            # Every other row knows all terms; the rest lack a quarter of them, as new texts do.
            value.append(features(text, terms.value, i // 2 % 4 if i % 2 else None).astype(np.float32))
            at.append(np.arange(DIMS, dtype=np.int32))
        return at, value

    examples = stages.write(
        with_columns(rows, "text", make, "at array<int>, value array<float>").select("label", "pick", "at", "value"),
        "examples")
    return spark.sparkContext.broadcast((terms.value, train(examples, MODEL, stages).astype(np.float64)))


def scored(docs: DataFrame, model) -> DataFrame:
    """doc_id, held_out, score and predicted of every row, and the number of hits by kind."""
    def make(texts):
        lexicon, weights = model.value
        score, n_hits, n_quoted = [], [], []
        for text in texts:
            values = features(text, lexicon)
            score.append(float(probability(values @ weights)))
            found = np.rint(np.expm1(values[1:13]))
            n_hits.append(int(found.sum()))
            n_quoted.append(int(found.reshape(3, 2, 2)[:, 1].sum()))
        return score, n_hits, n_quoted

    rows = with_columns(docs.select("doc_id", "text"), "text", make, "score double, n_terms long, n_quoted long")
    return rows.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
                       (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_terms", "n_quoted")

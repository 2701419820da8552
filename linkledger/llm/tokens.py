"""Token ids of texts by a byte-level BPE of the ``tokenizers`` library.

The tokenizer's own split begins a piece at every blank, and at every line feed and the letter after it, as long as no
other white space touches them. So lines are cut into words, words are encoded once each and looked up afterwards; a
text where blanks or line feeds meet other white space goes to the tokenizer whole, and so does one that holds an added
token. Letters and a run of marks after them are two pieces of that split; letters go straight to the tokenizer's BPE
model, and marks are looked up. All ways give the ids that the tokenizer gives for the whole text.
"""

from __future__ import annotations

import functools
import os
import re
from array import array

import numpy as np

#: White space other than blanks and line feeds.
_RARE = tuple(c for c in map(chr, range(0x3001)) if c not in " \n" and re.fullmatch(r"\s", c))
#: What sends a text to the tokenizer whole: a blank or line feed beside other white space. Line feeds may meet.
_MEETING = re.compile(r" \s|\s |\n[^\S\n]|[^\S\n]\n")
_FEEDS = re.compile("(\n\n+)")
#: Words of one generation of a table; two are kept.
_WORDS = 150_000
#: Runs of marks whose ids are kept.
_MARK_RUNS = 5_000
#: Letters, and a run of ASCII marks after them. Apostrophes are left to the tokenizer, which has rules for them.
_SHAPE = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-`{-~]+)")


class Encoder:
    """Ids of texts, as numbers or as the bytes of little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.written, blank = self._alphabet()
        self.marks: dict[str, bytes] = {}
        self.feeds: dict[int, bytes] = {}
        self.first = _Table(functools.partial(self._word, "", ""))
        self.words = _Table(functools.partial(self._word, " ", blank))

    def clear(self) -> None:
        for table in (self.first, self.words):
            table.clear()
            table.older.clear()

    def _alphabet(self) -> tuple[dict[int, str], str]:
        """How the tokenizer's split writes the bytes of Latin letters, and a blank."""
        split = self.tokenizer.pre_tokenizer
        out = {}
        for char in (chr(c) for c in range(0x41, 0x250) if chr(c).isalpha()):
            out |= dict(zip(char.encode(), "".join(piece for piece, _ in split.pre_tokenize_str(char))))
        return out, split.pre_tokenize_str(" a")[0][0][0]

    def _plain(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _run(self, marks: str) -> bytes:
        """Ids of a run of marks, which is a piece of its own."""
        found = self.marks.get(marks)
        if found is None:
            if len(self.marks) >= _MARK_RUNS:
                self.marks.clear()
            found = self.marks[marks] = self._plain(marks)
        return found

    def _word(self, before: str, blank: str, word: str) -> bytes:
        """Ids of a word without blanks or line feeds, ``before`` it a blank (written ``blank``) or nothing."""
        core, marks = word, ""
        if not word.isalpha() and (shape := _SHAPE.fullmatch(word)):
            core, marks = shape.groups()
        if core.isascii() and core.isalpha():
            piece = core
        elif core.isalpha() and max(core) < "\u0250":
            piece = core.encode().decode("latin-1").translate(self.written)
        else:
            return self._plain(before + word) if before or word else b""
        found = array("I", [t.id for t in self.model.tokenize(blank + piece)]).tobytes()
        return found + self._run(marks) if marks else found

    def _between(self, n: int) -> bytes:
        """Ids of n line feeds between two letters."""
        found = self.feeds.get(n)
        if found is None:
            ends = len(self._plain("a"))
            found = self._plain("a" + "\n" * n + "a")[ends:-ends]
            if n < 100:
                self.feeds[n] = found
        return found

    def _whole(self, text: str) -> bool:
        """Whether a text goes to the tokenizer as it is."""
        return (not text or text[0].isspace() or text[-1].isspace() or "  " in text or " \n" in text or "\n " in text
                or any(t in text for t in self.added)
                or any(c in text for c in _RARE) and _MEETING.search(text) is not None)

    def encode(self, text: str) -> np.ndarray:
        return as_numbers(self.encode_bytes(text))

    def encode_bytes(self, text: str) -> bytes:
        if self._whole(text):
            return self._plain(text)
        out, feed, word = [], self._between(1), self.words.__getitem__
        for run in _FEEDS.split(text) if "\n\n" in text else (text,):
            if run.startswith("\n"):
                out.append(self._between(len(run)))
                continue
            for number, line in enumerate(run.split("\n")):
                first, *rest = line.split(" ")
                if number:
                    out.append(feed)
                out.append(self.first[first])
                out.extend(map(word, rest))
        return b"".join(out)


class _Table(dict):
    """Words seen lately with their ids: when the table is full its words become the older generation, and words that
    are used again move back, so that frequent ones stay."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        if len(self) >= _WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = value
        return value


def as_numbers(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, "<u4")


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per process and file."""
    return Encoder(path)

"""Word shingles as sorted arrays of 64-bit hashes.

Two shingles count as equal if their hashes are; among n different ones that fails with a chance of n * n / 2**65.
"""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Odd multipliers, one per place in a shingle.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                    0x85EBCA77C2B2AE63], np.uint64)
#: Bytes hashed at one time, the base of word hashes and its powers, and those of its inverse.
_STRETCH = 1 << 15
_BASE = 0xA0761D6478BD642F
_POWERS, _BACK = (np.multiply.accumulate(np.array([1] + [b] * _STRETCH, np.uint64))
                  for b in (_BASE, pow(_BASE, -1, 1 << 64)))
_BLANKS = b" \t\n\v\f\r"
_BLANK = np.isin(np.arange(256), list(_BLANKS))


def words(text: str) -> list[bytes]:
    """Words between white space of ASCII, A-Z in lower case."""
    return lowered(text).split()


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that any bits of them can serve as a hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _coded(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Of each word of up to _STRETCH bytes: a number, a polynomial of its bytes modulo 2**64 with its length mixed in;
    and its last three bytes, as they are in a number of 24 bits."""
    read = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(~_BLANK[read], prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    sums = np.zeros(len(read) + 1, np.uint64)
    np.cumsum((read.astype(np.uint64) + np.uint64(1)) * _POWERS[: len(read)], out=sums[1:])
    length = ends - starts
    last = read[ends - 1].astype(np.uint32)
    for k in (2, 3):
        last |= np.where(length >= k, read[np.maximum(ends - k, 0)], 0).astype(np.uint32) << np.uint32(8 * k - 8)
    return mixed((sums[ends] - sums[starts]) * _BACK[starts] + length.astype(np.uint64) * _PLACES[0]), last


def coded_words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and last three bytes of the words of a text in lower case, in their order; a stretch is read at a time."""
    out, at = [(np.empty(0, np.uint64), np.empty(0, np.uint32))], 0
    while at < len(data):
        end = at + _STRETCH
        if end <= len(data):
            end = max(data.rfind(c, at, end) for c in _BLANKS) + 1
            if not end:
                # A word that fills a stretch and more: by itself, as whole.
                word = data[at:].split(None, 1)[0]
                out.append((np.array([xxhash.xxh3_64_intdigest(word)], np.uint64),
                            np.array([int.from_bytes(word[:-4:-1], "little")], np.uint32)))
                at += len(word)
                continue
        out.append(_coded(data[at:end]))
        at = end
    return tuple(map(np.concatenate, zip(*out))) if len(out) > 2 else out[-1]


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER)


def word_hashes(text: str) -> np.ndarray:
    """Numbers of the words, in their order."""
    return coded_words(lowered(text))[0]


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingles of WORDS words, sorted; of fewer words the whole sequence as one; none without words."""
    h = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(h):
        return h
    width = min(WORDS, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        total += h[i: len(h) - width + 1 + i] * _PLACES[i]
    total = mixed(total)
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]

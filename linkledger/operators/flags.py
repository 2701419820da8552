"""Outcomes of many checks as bits of a few long words.

A check is judged once per row and kept as bits: in a word it has a mask, set if the row is in its scope, and a bit
inside or beside the mask, set if it counts. Whatever counts checks, lists failures or asks for a clean row reads the
bits. Reading needs little code, whatever the number of checks: their places are one constant list, and rows of that
list meet the words by shifts and masks.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from linkledger.config import SLICE
from linkledger.functions.columns import lit


@dataclass(frozen=True)
class Check:
    """Where a check's outcome is: ``word`` is a column of longs."""

    name: str
    word: str
    bit: int
    mask: int

    @property
    def counts(self) -> str:
        return f"({self.word} & {1 << self.bit}L) <> 0"

    @property
    def applies(self) -> str:
        return f"({self.word} & {self.mask}L) <> 0"


def folded(keep: Iterable[str] = SLICE) -> list[str]:
    """The slice columns, those not kept replaced by 'ALL'."""
    return [d if d in keep else f"'ALL' AS {d}" for d in SLICE]


def _words(checks: list[Check]) -> list[str]:
    return sorted({c.word for c in checks})


def _met(df: DataFrame, columns: list[str], checks: list[Check]) -> DataFrame:
    """``columns`` of every row with each check: metric_name, and ``applies`` and ``counts`` as booleans."""
    words = _words(checks)
    places = ", ".join(
        f"named_struct('metric_name', {lit(c.name)}, '_word', {words.index(c.word)}, '_bit', {1 << c.bit}L, '_mask', {c.mask}L)"
        for c in checks)
    value = words[0] if len(words) == 1 else (
        "CASE _word " + " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(words)) + " END")
    return df.selectExpr(*columns, *words, f"inline(array({places}))").selectExpr(
        *columns, "metric_name", f"({value} & _mask) <> 0 AS applies", f"({value} & _bit) <> 0 AS counts")


def tally(df: DataFrame, checks: list[Check], keep: Iterable[str] = SLICE) -> DataFrame:
    """metric_name, slice, numerator and denominator of every check and slice with a row in its scope.

    Rows alike in slice and words are counted first, so the list of checks meets few of them."""
    words = _words(checks)
    alike = df.selectExpr(*folded(keep), *words).groupBy(*SLICE, *words).agg(F.expr("count(*) AS _n"))
    met = _met(alike, [*SLICE, "_n"], checks).filter("applies")
    return met.groupBy("metric_name", *SLICE).agg(
        F.expr("coalesce(sum(CASE WHEN counts THEN _n END), 0) AS numerator"), F.expr("sum(_n) AS denominator"))


def failures(df: DataFrame, key: str, checks: list[Check]) -> DataFrame:
    """(key, metric_name) of every check that counts for any row of the key, once."""
    words = _words(checks)
    masks = {w: sum({1 << c.bit for c in checks if c.word == w}) for w in words}
    found = df.selectExpr(key, *(f"{w} & {masks[w]}L AS {w}" for w in words)).filter(
        " OR ".join(f"{w} <> 0" for w in words))
    per_key = found.groupBy(key).agg(*(F.expr(f"bit_or({w}) AS {w}") for w in words))
    return _met(per_key, [key], checks).filter("counts").select(key, "metric_name")

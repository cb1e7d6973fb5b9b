"""Synonyms of one or several words as a graph of terms, so that phrases match across them.

Rules are lines: ``a b, c => d e, f`` puts the right sides in the place of any left one, ``a b, c`` makes all sides stand for each
other. An automaton over the left sides reads a text's terms once and takes the longest match at each place, without overlap. A term
is an edge (term, start, end) between the places of the text; a side of several words has places of its own between the first and
the last, so words of different sides never make a phrase that no side has.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Side = tuple[str, ...]
EDGES = "array<struct<term:string,start:int,end:int>>"


class Rules:
    """The automaton of some rules; picklable."""

    def __init__(self, lines: Iterable[str]):
        self.root: dict = {}
        for line in lines:
            line = line.partition("#")[0].strip()
            if not line:
                continue
            left, arrow, right = line.partition("=>")
            froms = self._sides(left)
            if not froms or arrow and not self._sides(right):
                raise ValueError(f"a side is missing: {line!r}")
            for side in froms:
                self._add(side, self._sides(right) if arrow else froms)

    @staticmethod
    def _sides(text: str) -> list[Side]:
        return [tuple(s.lower().split()) for s in text.split(",") if s.strip()]

    def _add(self, side: Side, to: Sequence[Side]) -> None:
        at = self.root
        for word in side:
            at = at.setdefault(word, {})
        # None is no term; rules of one left side add up
        at.setdefault(None, []).extend(x for x in to if x not in at.get(None, []))

    def edges(self, terms: Sequence[str]) -> list[tuple[str, int, int]]:
        """The graph of a text: places of the text are 0 to its number of terms, those inside of sides come after."""
        out, i, spare = [], 0, len(terms) + 1
        while i < len(terms):
            at, k, end, sides = self.root, i, i, None
            while k < len(terms) and terms[k] in at:
                at, k = at[terms[k]], k + 1
                if None in at:
                    end, sides = k, at[None]
            if sides is None:
                out.append((terms[i], i, i + 1))
                i += 1
                continue
            for side in sides:
                places = [i, *range(spare, spare + len(side) - 1), end]
                spare += len(side) - 1
                out += [(w, a, b) for w, a, b in zip(side, places[:-1], places[1:], strict=True)]
            i = end
        return out

    def has(self, terms: Sequence[str], phrase: Sequence[str]) -> bool:
        """Whether a text's graph has the words of a phrase after each other."""
        by: dict[str, list[tuple[int, int]]] = {}
        for term, start, end in self.edges(terms):
            by.setdefault(term, []).append((start, end))
        at: set[int] | None = None
        for word in phrase:
            at = {end for start, end in by.get(word, ()) if at is None or start in at}
            if not at:
                return False
        return bool(phrase)


def graph(terms: Column, lines: Iterable[str]) -> Column:
    """The edges of arrays of terms; null stays null."""
    rules = Rules(lines)

    @F.pandas_udf(EDGES)
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda ts: None if ts is None else [{"term": t, "start": a, "end": b} for t, a, b in rules.edges(list(ts))])

    return run(terms)


def phrases(terms: Column, lines: Iterable[str], wanted: Sequence[str]) -> Column:
    """Whether arrays of terms have each of some phrases, across synonyms: array<boolean>."""
    rules, split = Rules(lines), [p.lower().split() for p in wanted]

    @F.pandas_udf("array<boolean>")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda ts: None if ts is None else [rules.has(list(ts), p) for p in split])

    return run(terms)

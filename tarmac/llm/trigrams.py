"""Boolean trigram queries of regular expressions, and an inverted index over a block of texts."""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from re import _constants as op  # the parse tree of the standard library
from re import _parser

# Beyond this many exact strings, a part of a pattern counts as "anything".
MOST = 64


@dataclass(frozen=True)
class Query:
    """``kind`` is "all" (no demand), "and" or "or"; parts are trigrams or further queries."""

    kind: str
    parts: frozenset = frozenset()

    def trigrams(self) -> set[str]:
        return {t for p in self.parts for t in ([p] if isinstance(p, str) else p.trigrams())}

    def rows(self, postings: dict[str, np.ndarray], n: int) -> np.ndarray:
        """Rows that can match: postings intersected and united as the query says."""
        if self.kind == "all":
            return np.arange(n)
        sets = [postings[p] if isinstance(p, str) else p.rows(postings, n) for p in self.parts]
        join = np.intersect1d if self.kind == "and" else np.union1d
        found = sets[0]
        for other in sets[1:]:
            found = join(found, other)
        return found


ALL = Query("all")


def _and(parts) -> Query:
    parts = frozenset(p for p in parts if p != ALL)
    if not parts:
        return ALL
    only = next(iter(parts))
    return only if len(parts) == 1 and isinstance(only, Query) else Query("and", parts)


def _or(parts) -> Query:
    parts = frozenset(parts)
    if ALL in parts or not parts:
        return ALL
    return next(iter(parts)) if len(parts) == 1 else Query("or", parts)


def _of_string(text: str) -> Query:
    return _and(text[i : i + 3] for i in range(len(text) - 2))


def _of_strings(strings) -> Query:
    return _or(_of_string(s) for s in strings)


def trigram_query(pattern: str) -> Query:
    """What every match of ``pattern`` must contain, over ASCII-lower-cased text."""
    exact, demands = _walk(list(_parser.parse(pattern)))
    return _and([*demands, *([_of_strings(exact)] if exact else [])])


def _walk(nodes) -> tuple[set[str] | None, list[Query]]:
    """The exact strings of a sequence (None: not a small set) and the demands of its parts."""
    run: set[str] | None = {""}
    whole, demands = True, []
    for node in nodes:
        strings, inner = _one(node)
        demands += inner
        joined = {a + b for a in run for b in strings} if strings else None
        if joined is not None and len(joined) <= MOST:
            run = joined
        else:
            # The run of exact strings ends here; what it demands stays, a new one begins.
            whole = False
            demands.append(_of_strings(run))
            run = strings if strings and len(strings) <= MOST else {""}
    if whole:
        return run, demands
    return None, [*demands, _of_strings(run)]


def _one(node) -> tuple[set[str] | None, list[Query]]:
    kind, arg = node
    if kind is op.LITERAL:
        return ({chr(arg).lower()} if arg < 128 else None), []
    if kind is op.IN:
        members = set()
        for what, value in arg:
            if what is op.LITERAL and value < 128:
                members.add(chr(value).lower())
            elif what is op.RANGE and value[1] < 128 and value[1] - value[0] < 8:
                members |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, []
        return members, []
    if kind is op.SUBPATTERN:
        return _walk(list(arg[-1]))
    if kind is op.BRANCH:
        branches = [_walk(list(b)) for b in arg[1]]
        if all(s is not None for s, _ in branches):
            return set().union(*[s for s, _ in branches]), []
        return None, [_or(_and([*d, *([_of_strings(s)] if s else [])]) for s, d in branches)]
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, body = arg
        strings, inner = _walk(list(body))
        if low == high == 1:
            return strings, inner
        if low == 0:
            return (({""} | strings) if high == 1 and strings else None), []
        if strings and low == high and len(strings) ** low <= MOST:
            out = {""}
            for _ in range(low):
                out = {a + b for a in out for b in strings}
            return out, []
        # At least one occurrence.
        return None, [*inner, *([_of_strings(strings)] if strings else [])]
    if kind is op.AT:
        return {""}, []
    return None, []


class Index:
    """Postings of the given trigrams over a block of UTF-8 texts, ASCII letters folded."""

    def __init__(self, trigrams: set[str]):
        self.trigrams = sorted(trigrams)
        self._number = np.zeros(1 << 24, np.uint16)
        for k, t in enumerate(self.trigrams, 1):
            a, b, c = t.encode()
            self._number[a << 16 | b << 8 | c] = k
        self._fold = np.arange(256, dtype=np.uint32)
        self._fold[65:91] += 32

    def postings(self, blob: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
        """Rows that hold each trigram; ``blob`` has the bytes of all texts, ``offsets`` their bounds."""
        empty = np.empty(0, np.int64)
        found = dict.fromkeys(self.trigrams, empty)
        if len(blob) < 3:
            return found
        numbers, places = [], []
        for start in range(0, len(blob) - 2, 1 << 22):
            folded = self._fold[blob[start : start + (1 << 22) + 2]]
            code = folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]
            number = self._number[code]
            at = np.flatnonzero(number)
            numbers.append(number[at])
            places.append(at + start)
        number, place = np.concatenate(numbers), np.concatenate(places)
        row = np.searchsorted(offsets, place, side="right") - 1
        inside = place + 3 <= offsets[row + 1]
        pairs = np.unique(number[inside].astype(np.int64) << 40 | row[inside])
        kinds, rows = pairs >> 40, pairs & ((1 << 40) - 1)
        bounds = np.searchsorted(kinds, np.arange(1, len(self.trigrams) + 2))
        for k, t in enumerate(self.trigrams):
            found[t] = rows[bounds[k] : bounds[k + 1]]
        return found


def matcher(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.ASCII)

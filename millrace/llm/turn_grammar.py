"""Cheapest repairs of role/fault sequences by a grammar: one min-plus transfer matrix with audit ropes per symbol.

A row is one of nine symbols: ``D`` has to be deleted (blank or duplicate); ``s``, ``u``, ``a`` and ``o`` are sound
rows by role initial (``o``: any other); in upper case the row is truncated. Repairs lead through an automaton of
four states that accepts the role initials ``(s?(ua)+)?``. The matrix of a symbol has, for every pair of states, the
least cost of edits that lead from one to the other over the symbol's rows, and the ASCII-least audit of that cost.

Edits of equal cost over the same rows are never prefixes of each other (every letter more is one more edit to pay),
so the lesser of two audits stays the lesser whatever follows, and matrices may be multiplied in any grouping.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

RETAG, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (START, ASSISTANT)
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
TERMINALS = "DsuaoSUAO"
FIRST_RULE = 0xE000  # rules are written as characters of the private use area
_MOD, _BASE = (1 << 61) - 1, 0x1F3D5B79A2C4E689


class Rope:
    """A text kept as a tree of shared parts, with a hash by which equal parts are passed over in comparisons."""

    __slots__ = ("parts", "text", "length", "code", "power")

    def __init__(self, text: str = "", parts: tuple[Rope, Rope] | None = None):
        self.text, self.parts = text, parts
        if parts:
            a, b = parts
            self.length, self.power = a.length + b.length, a.power * b.power % _MOD
            self.code = (a.code * b.power + b.code) % _MOD
        else:
            self.length, self.power, self.code = len(text), pow(_BASE, len(text), _MOD), 0
            for c in text:
                self.code = (self.code * _BASE + ord(c)) % _MOD

    def __add__(self, other: Rope) -> Rope:
        if not self.length or not other.length:
            return self if self.length else other
        return Rope(parts=(self, other))

    def __lt__(self, other: Rope) -> bool:
        left, right = [self], [other]
        while left and right:
            a, b = left.pop(), right.pop()
            if a is b or (a.length == b.length and a.code == b.code):
                continue
            if a.parts and (a.length >= b.length or not b.parts):
                left += a.parts[::-1]
                right.append(b)
            elif b.parts:
                right += b.parts[::-1]
                left.append(a)
            else:
                n = min(a.length, b.length)
                if a.text[:n] != b.text[:n]:
                    return a.text[:n] < b.text[:n]
                left += [Rope(a.text[n:])] * (a.length > n)
                right += [Rope(b.text[n:])] * (b.length > n)
        return bool(right) and not left

    def __str__(self) -> str:
        out, rest = [], [self]
        while rest:
            rope = rest.pop()
            if rope.parts:
                rest += rope.parts[::-1]
            else:
                out.append(rope.text)
        return "".join(out)


Entry = tuple[int, Rope]
Matrix = list[dict[int, Entry]]


def _better(old: Entry | None, new: Entry) -> Entry:
    if old is None or new[0] < old[0] or (new[0] == old[0] and new[1] < old[1]):
        return new
    return old


def advance(row: dict[int, Entry], matrix: Matrix) -> dict[int, Entry]:
    """One row of costs and audits, carried over a symbol."""
    out: dict[int, Entry] = {}
    for middle, (cost, audit) in row.items():
        for state, (more, edits) in matrix[middle].items():
            known = out.get(state)
            if known is None or cost + more <= known[0]:
                out[state] = _better(known, (cost + more, audit + edits))
    return out


def multiplied(a: Matrix, b: Matrix) -> Matrix:
    return [advance(row, b) for row in a]


def _inserts() -> Matrix:
    """Rows put in without reading one: up to two, as two lead back to the same state or accept."""
    steps = [{state: (0, Rope())} for state in range(4)]
    for state in range(4):
        at, text = state, ""
        for _ in range(2):
            at = ASSISTANT if at == USER else USER
            text += "I"
            if at not in steps[state]:
                steps[state][at] = (INSERT * len(text), Rope(text))
    return steps


def _terminal(symbol: str) -> Matrix:
    """The edits of one row, and inserts after it."""
    edits: Matrix = []
    for state in range(4):
        out: dict[int, Entry] = {state: (DELETE, Rope("D"))}
        if symbol != "D":
            extra = TRUNCATED if symbol.isupper() else 0
            moves = [("K", 0, STEPS.get(symbol.lower(), {}))] + [("R", RETAG, STEPS[role]) for role in "ua"]
            for letter, cost, step in moves:
                if state in step:
                    out[step[state]] = _better(out.get(step[state]), (cost + extra, Rope(letter)))
        edits.append(out)
    return multiplied(edits, _inserts())


class Grammar:
    """Rules of two symbols each, evaluated bottom-up once and shared by all sequences."""

    def __init__(self, rules: Sequence[str]):
        self.rules = list(rules)
        self.matrices = {symbol: _terminal(symbol) for symbol in TERMINALS}
        for i, pair in enumerate(self.rules):
            self.matrices[chr(FIRST_RULE + i)] = multiplied(self.matrices[pair[0]], self.matrices[pair[1]])

    def compressed(self, symbols: str) -> str:
        return compressed(symbols, self.rules)

    def repair(self, chunks: Iterable[str]) -> Entry:
        """Cost and audit of a sequence that comes in chunks.

        Between chunks the part that all states' audits share is put aside, so that what is kept of long
        sequences is the audit and short tails.
        """
        row, settled = _inserts()[START], []
        for chunk in chunks:
            for symbol in self.compressed(chunk):
                row = advance(row, self.matrices[symbol])
            tails = {state: str(audit) for state, (_, audit) in row.items()}
            low, high = min(tails.values()), max(tails.values())
            n = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
            settled.append(low[:n])
            row = {state: (row[state][0], Rope(tail[n:])) for state, tail in tails.items()}
        best = None
        for state in ACCEPTING:
            if state in row:
                best = _better(best, row[state])
        return best[0], Rope("".join(settled) + str(best[1]))


@lru_cache(maxsize=4)
def grammar(rules: tuple[str, ...]) -> Grammar:
    return Grammar(rules)


def compressed(symbols: str, rules: Sequence[str], first: int = 0) -> str:
    """The sequence with rules put in, in their order, from rule ``first`` on."""
    for i in range(first, len(rules)):
        symbols = symbols.replace(rules[i], chr(FIRST_RULE + i))
    return symbols


def digrams(symbols: str) -> Iterator[str]:
    """Pairs of neighbours that do not overlap with the same pair before."""
    at, last = -2, ""
    for i, pair in enumerate(map("".join, zip(symbols, symbols[1:], strict=False))):
        if pair == last and i == at + 1:
            last = ""
            continue
        at, last = i, pair
        yield pair


def count_digrams(sequences: Iterable[tuple[str, int]]) -> Counter:
    counts: Counter = Counter()
    for symbols, times in sequences:
        for pair in digrams(symbols):
            counts[pair] += times
    return counts

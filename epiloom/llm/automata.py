"""Probabilistic automata by state merging (ALERGIA: Carrasco and Oncina, 1994).

Strings are read as classes of characters. The prefix tree of a sample is
folded: two states merge if the shares of their endings and next symbols, and
those of all states behind them, differ no more than the Hoeffding bound allows.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterable

#: Symbol of a character class and how many characters it holds.
CLASSES = {"d": 10, "f": 6, "z": 20, "U": 6, "Z": 20}
_SYMBOL = {c: "d" for c in "0123456789"} | {c: "f" for c in "abcdef"} | {c: "z" for c in "ghijklmnopqrstuvwxyz"}
_SYMBOL |= {c: "U" for c in "ABCDEF"} | {c: "Z" for c in "GHIJKLMNOPQRSTUVWXYZ"}
_TABLE = str.maketrans(_SYMBOL)
_KINDS = 12  # symbols that a state may go on with, for smoothing


def symbols_of(text: str) -> str:
    """Digits, hexadecimal and other letters by case as classes; every other character stands for itself."""
    return text.translate(_TABLE)


class Automaton:
    """States with counts: `ends`, and by symbol the next state and how often it was taken. State 0 begins."""

    def __init__(self, strings: Iterable[str] = (), alpha: float = 0.05) -> None:
        self.ends: list[int] = [0]
        self.next: list[dict[str, int]] = [{}]
        self.taken: list[dict[str, int]] = [{}]
        for s in strings:
            self._add(symbols_of(s))
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_all()
        self._steps: defaultdict[int, dict[str, tuple[float, int]]] = defaultdict(dict)

    def _add(self, symbols: str) -> None:
        at = 0
        for s in symbols:
            if s not in self.next[at]:
                self.next[at][s] = len(self.ends)
                self.ends.append(0)
                self.next.append({})
                self.taken.append({})
            self.taken[at][s] = self.taken[at].get(s, 0) + 1
            at = self.next[at][s]
        self.ends[at] += 1

    def _total(self, q: int) -> int:
        return self.ends[q] + sum(self.taken[q].values())

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            p, q = todo.pop()
            n, m = self._total(p), self._total(q)
            if not n or not m:
                continue
            most = self._bound * (math.sqrt(1 / n) + math.sqrt(1 / m))
            if abs(self.ends[p] / n - self.ends[q] / m) > most:
                return False
            for s in self.taken[p].keys() | self.taken[q].keys():
                if abs(self.taken[p].get(s, 0) / n - self.taken[q].get(s, 0) / m) > most:
                    return False
                if s in self.next[p] and s in self.next[q]:
                    todo.append((self.next[p][s], self.next[q][s]))
        return True

    def _fold(self, into: int, tree: int) -> None:
        """Add the counts of a tree to the states it falls on."""
        todo = [(into, tree)]
        while todo:
            p, q = todo.pop()
            self.ends[p] += self.ends[q]
            for s, n in self.taken[q].items():
                self.taken[p][s] = self.taken[p].get(s, 0) + n
                if s in self.next[p]:
                    todo.append((self.next[p][s], self.next[q][s]))
                else:
                    self.next[p][s] = self.next[q][s]

    def _merge_all(self) -> None:
        red = [0]
        while True:
            done = set(red)
            fringe = [(p, s, q) for p in red for s, q in sorted(self.next[p].items()) if q not in done]
            if not fringe:
                break
            parent, symbol, blue = max(fringe, key=lambda x: self._total(x[2]))
            for p in red:
                if self._compatible(p, blue):
                    self.next[parent][symbol] = p
                    self._fold(p, blue)
                    break
            else:
                red.append(blue)
        self.states = len(red)

    def log_likelihood(self, text: str) -> float:
        """Mean natural log of the probability of each character and the end, smoothed; -inf without a sample."""
        return self.of_symbols(symbols_of(text))

    def of_symbols(self, symbols: str) -> float:
        """The same from the symbols of a text."""
        if not self._total(0):
            return -math.inf
        at, total = 0, 0.0
        for s in symbols:
            step = self._steps[at].get(s)
            if step is None:
                step = self._steps[at][s] = self._step(at, s)
            total += step[0]
            at = step[1]
        if at >= 0:
            total += math.log((self.ends[at] + 0.01) / (self._total(at) + 0.01 * _KINDS))
        return total / (len(symbols) + 1)

    def _step(self, at: int, s: str) -> tuple[float, int]:
        """Log of the probability of a character in a state, and the next state; -1 is behind all that the sample holds."""
        share = 1 / (4 * _KINDS) if at < 0 else (self.taken[at].get(s, 0) + 0.01) / (self._total(at) + 0.01 * _KINDS)
        return math.log(share) - math.log(CLASSES.get(s, 1)), -1 if at < 0 else self.next[at].get(s, -1)

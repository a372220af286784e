"""Probabilistic automata learned from example strings by state merging."""

from __future__ import annotations

import math
from collections import Counter, deque

#: Fixed classes of the characters of a credential; any other character stands for itself.
CLASSES = {**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "h"),
           **dict.fromkeys("ghijklmnopqrstuvwxyz", "a"),
           **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "A")}
_TABLE = str.maketrans(CLASSES)
#: Characters of each class; any other symbol is one character.
SIZE = {"0": 10, "h": 6, "a": 20, "A": 26}


def shape(value: str) -> str:
    return value.translate(_TABLE)


class Automaton:
    """A deterministic automaton whose states carry pass and end counts.

    States of equal depth are merged first, so that all examples count at each
    position; states of different depths only where the test has enough counts
    to tell any frequencies apart. Few examples thus give a narrow format
    (the lengths seen, and at each position the classes seen), not a wide one.
    States whose ranges of remaining lengths do not meet are not merged.

    The symbols are the classes of ``shape``. Given the ``values`` behind the
    words, each state also knows its characters: a class that was only ever
    one character at a state is fixed to it, as far as the number of examples
    speaks for that; in any other its characters are equally likely.
    """

    def __init__(self, words: list[str], alpha: float = 0.05, smooth: float = 0.1, values: list[str] | None = None):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.end, self.seen = [0], [0]
        for w in words:
            q = 0
            for c in w:
                self.seen[q] += 1
                self.count[q][c] = self.count[q].get(c, 0) + 1
                if c not in self.next[q]:
                    self.next[q][c] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.end.append(0)
                    self.seen.append(0)
                q = self.next[q][c]
            self.seen[q] += 1
            self.end[q] += 1
        self._bound = math.sqrt(0.5 * math.log(2 / alpha))
        self._into = list(range(len(self.next)))  # the state that a merged state went into
        self._merge_layers()
        self._heights()
        self._merge_states()
        self._renumber()
        self._alphabet = {c for t in self.next for c in t}
        self._smooth = smooth
        self._smoothed()
        self._characters(values or [])

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        if not n1 or not n2:
            return False
        return abs(f1 / n1 - f2 / n2) > self._bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _state(self, q: int) -> int:
        while self._into[q] != q:
            self._into[q] = self._into[self._into[q]]
            q = self._into[q]
        return q

    def _tells(self, a: int, b: int) -> bool:
        """Whether the test could tell any frequencies of the two states apart."""
        return self._bound * (self.seen[a] ** -0.5 + self.seen[b] ** -0.5) < 1

    def _compatible(self, a: int, b: int) -> bool:
        """Hoeffding test of the end and symbol frequencies of two states and all states below both."""
        todo, met = [(a, b)], {(a, b)}
        while todo:
            a, b = todo.pop()
            n1, n2 = self.seen[a], self.seen[b]
            if self._differ(self.end[a], n1, self.end[b], n2):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if self._differ(self.count[a].get(c, 0), n1, self.count[b].get(c, 0), n2):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    pair = self._state(self.next[a][c]), self._state(self.next[b][c])
                    if pair[0] != pair[1] and pair not in met:
                        met.add(pair)
                        todo.append(pair)
        return True

    def _merge(self, a: int, b: int) -> None:
        """``b`` goes into ``a``, and what they reach by equal symbols into each other."""
        todo = [(a, b)]
        while todo:
            a, b = map(self._state, todo.pop())
            if a == b:
                continue
            self._into[b] = a
            self.seen[a] += self.seen[b]
            self.end[a] += self.end[b]
            for c, n in self.count[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + n
            for c, t in self.next[b].items():
                if c in self.next[a]:
                    todo.append((self.next[a][c], t))
                else:
                    self.next[a][c] = t

    def _merge_layers(self) -> None:
        """Merges the compatible states of each depth, from the root on."""
        layer = [0]
        while layer:
            below = dict.fromkeys(self._state(self.next[q][c]) for q in layer for c in sorted(self.next[q]))
            layer = []
            for b in below:
                for r in layer:
                    if self._compatible(r, b):
                        self._merge(r, b)
                        break
                else:
                    layer.append(b)

    def _heights(self) -> None:
        """Least and most symbols that may follow each state; the merged layers hold no cycle."""
        order = [0]
        met = {0}
        for q in order:
            for t in map(self._state, self.next[q].values()):
                if t not in met:
                    met.add(t)
                    order.append(t)
        self._least, self._most = {}, {}
        for q in reversed(order):
            below = [self._state(t) for t in self.next[q].values()]
            self._least[q] = 0 if self.end[q] else 1 + min(self._least[t] for t in below)
            self._most[q] = 1 + max((self._most[t] for t in below), default=-1)

    def _may_merge(self, a: int, b: int) -> bool:
        return (self._tells(a, b) and self._least[a] <= self._most[b] and self._least[b] <= self._most[a]
                and self._compatible(a, b))

    def _merge_states(self) -> None:
        """Red states are settled; each blue child of one is merged into a red state or becomes red."""
        red, strong = {0}, [0]  # a state met once is never told apart, so it is compared with none
        blue = deque((0, c) for c in sorted(self.next[0]))
        while blue:
            parent, c = blue.popleft()
            b = self._state(self.next[self._state(parent)][c])
            if b in red:
                continue
            r = next((r for r in strong if self._may_merge(r, b)), None) if self.seen[b] > 1 else None
            if r is None:
                red.add(b)
                if self.seen[b] > 1:
                    strong.append(b)
                blue.extend((b, x) for x in sorted(self.next[b]))
                continue
            self._least[r], self._most[r] = min(self._least[r], self._least[b]), max(self._most[r], self._most[b])
            self._merge(r, b)
            # merging may have joined red states and grown new children on any
            red = set(map(self._state, red))
            strong = list(dict.fromkeys(map(self._state, strong)))
            blue.extend((s, x) for s in strong for x in sorted(self.next[s])
                        if self._state(self.next[s][x]) not in red)

    def _renumber(self) -> None:
        """Keeps the states that the root reaches."""
        order = {self._state(0): 0}
        for q in (todo := list(order)):
            for c in sorted(self.next[q]):
                t = self._state(self.next[q][c])
                if t not in order:
                    order[t] = len(order)
                    todo.append(t)
        self.next = [{c: order[self._state(t)] for c, t in self.next[q].items()} for q in order]
        self.count = [self.count[q] for q in order]
        self.end = [self.end[q] for q in order]
        self.seen = [self.seen[q] for q in order]

    def _smoothed(self) -> None:
        """Log2 probabilities of each state: of its symbols, of any other (``None``) and of the end."""
        smooth, self._steps, self._ends = self._smooth, [], []
        for counts, nexts, end, seen in zip(self.count, self.next, self.end, self.seen):
            whole = seen + smooth * (len(self._alphabet) + 1)
            logs = {c: math.log2((n + smooth) / whole) for c, n in counts.items()}
            most = min(counts, key=lambda c: (-counts[c], c), default=None)
            self._steps.append((logs | {None: math.log2(smooth / whole)}, nexts.get(most)))
            self._ends.append(math.log2((end + smooth) / whole))

    def score(self, word: str, least: float = -math.inf) -> float:
        """Mean log2 probability of a symbol of ``word`` and of its end; given up below ``least``.

        A symbol not yet seen at a state has the smoothed probability and goes where most examples went.
        """
        q, total, floor = 0, 0.0, least * (len(word) + 1)
        for c in word:
            logs, after = self._steps[q]
            if c in logs:
                total += logs[c]
                q = self.next[q][c]
            elif c in self._alphabet and after is not None:
                total += logs[None]
                q = after
            else:
                return -math.inf
            if total < floor:
                return -math.inf
        return (total + self._ends[q]) / (len(word) + 1)

    def _characters(self, values: list[str]) -> None:
        """Log2 probability of a character given state and class, where it is not uniform in its class."""
        met: dict[tuple[int, str], Counter] = {}
        for value in values:
            q = 0
            for c, k in zip(value, shape(value)):
                met.setdefault((q, k), Counter())[c] += 1
                q = self.next[q][k]
        self._fixed: dict[tuple[int, str], tuple[str, float, float]] = {}
        for (q, k), counts in met.items():
            size = SIZE.get(k, 1)
            if size > 1 and len(counts) == 1:
                (c, n), = counts.items()
                w = 1 / (1 + size ** -float(min(n - 2, 100)))  # posterior of "always this character", from n equal draws
                rest = (w * self._smooth / (n + self._smooth) + 1 - w) / size
                self._fixed[q, k] = c, math.log2(w * n / (n + self._smooth) + rest), math.log2(rest)

    def bits(self, value: str, least: float = -math.inf) -> float:
        """Log2 probability of the characters of ``value`` and of its end; -inf as soon as it is below ``least``."""
        q, total = 0, 0.0
        for c, k in zip(value, shape(value)):
            logs, after = self._steps[q]
            known = k in logs
            if not known and (k not in self._alphabet or after is None):
                return -math.inf
            total += logs[k if known else None]
            fixed = self._fixed.get((q, k))
            total += (fixed[1] if c == fixed[0] else fixed[2]) if fixed else _UNIFORM.get(k, 0.0)
            if total < least:
                return -math.inf
            q = self.next[q][k] if known else after
        total += self._ends[q]
        return total if total >= least else -math.inf


_UNIFORM = {k: -math.log2(n) for k, n in SIZE.items()}

"""Stochastic grammar inference: prefix trees merged into probabilistic automata (ALERGIA).

A prefix tree holds how often each prefix of the training strings was reached,
left by each symbol, and was the end. States whose frequencies agree, by the
Hoeffding bound at ``alpha`` and recursively for their successors, are merged
and folded until no more agree. What results gives a probability for any
string.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence

FLOOR = 1e-4
#: Lengths near an example's are likely too: shares of the two kernels, and their widths as (symbols, part of the length).
NEAR, FAR = (0.7, 0.3, 0.0), (0.3, 1.0, 0.15)


class Automaton:
    """States with counts: ``seen[q]``, ``ends[q]``, ``next[q][symbol] = (state, times)``."""

    def __init__(self, strings: list[tuple[str, ...]], alpha: float = 0.05):
        self.seen, self.ends, self.next = [0], [0], [{}]
        self.lengths = Counter(map(len, strings))
        self.longest = max(self.lengths, default=0)
        self.total = len(strings)
        self._log_length: dict[int, float] = {}
        for s in sorted(strings):
            q = 0
            self.seen[0] += 1
            for c in s:
                if c not in self.next[q]:
                    self.next[q][c] = [len(self.seen), 0]
                    self.seen.append(0)
                    self.ends.append(0)
                    self.next.append({})
                step = self.next[q][c]
                step[1] += 1
                q = step[0]
                self.seen[q] += 1
            self.ends[q] += 1
        self._radius = math.sqrt(0.5 * math.log(2 / alpha))
        self._infer()

    def _differ(self, a: int, n: int, b: int, m: int) -> bool:
        return abs(a / n - b / m) > self._radius * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, p: int, q: int) -> bool:
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            n, m = self.seen[p], self.seen[q]
            if not n or not m:
                continue
            if self._differ(self.ends[p], n, self.ends[q], m):
                return False
            for c in self.next[p].keys() | self.next[q].keys():
                a, b = self.next[p].get(c), self.next[q].get(c)
                if self._differ(a[1] if a else 0, n, b[1] if b else 0, m):
                    return False
                if a and b and a[0] != b[0]:
                    todo.append((a[0], b[0]))
        return True

    def _merge(self, p: int, q: int, parent: int, symbol: str) -> None:
        """Point parent's step at p instead of the tree state q, and fold q's subtree into p."""
        self.next[parent][symbol][0] = p
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.seen[p] += self.seen[q]
            self.ends[p] += self.ends[q]
            for c, (state, times) in self.next[q].items():
                if c in self.next[p]:
                    self.next[p][c][1] += times
                    todo.append((self.next[p][c][0], state))
                else:
                    self.next[p][c] = [state, times]

    def _infer(self) -> None:
        red = [0]
        while True:
            blue = [(q, p, c) for p in red for c, (q, _) in sorted(self.next[p].items()) if q not in red]
            if not blue:
                break
            q, parent, symbol = max(blue, key=lambda x: (self.seen[x[0]], -x[0]))
            # the start state is no target: a rare state agrees with anything, and would loop back past the head
            same = next((p for p in sorted(red[1:], key=lambda p: -self.seen[p]) if self._compatible(p, q)), None)
            if same is None:
                red.append(q)
            else:
                self._merge(same, q, parent, symbol)
        self.states = len(red)

    def log_probability(self, s: tuple[str, ...]) -> float:
        """Natural log of the string's probability, its length included; unseen steps, and the end behind them, get FLOOR."""
        return self.log_probabilities(s, [len(s)])[0]

    def log_probabilities(self, s: Sequence[str], ends: list[int]) -> list[float]:
        """Those of the beginnings of s with the (rising) lengths ``ends``, in one walk."""
        q, out, k, found = 0, 0.0, 0, []
        for n in ends:
            while k < n and (step := self.next[q].get(s[k])) is not None:
                out += math.log(step[1] / max(1, self.seen[q]))
                q = step[0]
                k += 1
            if k < n:
                found.append(out + (n - k + 1) * math.log(FLOOR) + self.log_length(n))  # nor has such an end been seen
            else:
                end = math.log(max(FLOOR, self.ends[q] / max(1, self.seen[q])))
                found.append(out + end + self.log_length(n))
        return found

    def walk(self, head: str, s: Sequence[str], at: int, ends: Sequence[int]) -> Iterator[tuple[int, float, bool]]:
        """(end, log probability without the length's, whether the last step was seen) of head and s[at:end], by rising
        ends in one walk that copies nothing; the head, or else the first symbol, is a step from the start."""
        q, out, k = 0, 0.0, at
        if head:
            q, times = self.next[0][head]
            out = math.log(times / max(1, self.seen[0]))
        for end in ends:
            while k < end and (step := self.next[q].get(s[k])) is not None:
                out += math.log(step[1] / max(1, self.seen[q]))
                q = step[0]
                k += 1
            if k < end:
                yield end, out + (end - k + 1) * math.log(FLOOR), False
            else:
                yield end, out + math.log(max(FLOOR, self.ends[q] / max(1, self.seen[q]))), True

    def log_length(self, n: int) -> float:
        """Natural log of the probability of a length: the examples' lengths, each spread over those around it."""
        if n not in self._log_length:
            p = 0.0
            for m, times in self.lengths.items():
                for share, symbols, part in (NEAR, FAR):
                    ratio = math.exp(-1 / (symbols + part * m))  # of one length to the next
                    p += times * share * (1 - ratio) / (1 + ratio) * ratio ** abs(n - m)
            self._log_length[n] = math.log(max(p / max(1, self.total), FLOOR ** 8))
        return self._log_length[n]

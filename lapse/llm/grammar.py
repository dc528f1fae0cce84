"""Probabilistic automata from strings: state merging over a prefix tree (in-task helpers of operator 13).

The strings become a prefix tree with counts.  Starting from the root, states are settled one by one:
the most frequent child not yet settled is merged into a settled state whose outgoing frequencies
(symbols and end) agree with its own by Hoeffding's bound, and so on down both subtrees; among several the one
that gives its strings the highest likelihood is taken; a child that agrees with none is settled as a
state of its own.  Strings are bytes over ``SYMBOLS``.

Counts of any number of strings are compared as frequencies of ``RESOLUTION`` strings at most (``scale``): they become
more exact with more strings, but differences too small for that many make no states.  Subtrees below one
of these never tell states apart, so a tree may come without them; ``resume`` takes them later, as a tree below the states
that were settled without them.
"""

from __future__ import annotations

import math

import numpy as np

SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"
END = len(SYMBOLS)
ALPHA = 0.05
RESOLUTION = 1500
SMOOTH = 0.05

CODE = np.zeros(256, np.int64)
CODE[np.frombuffer(SYMBOLS, np.uint8)] = np.arange(END)


class Automaton:
    """Counts of a deterministic automaton: per state the visits, ends, and (next, count) by symbol."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.times: list[dict[int, int]] = [{}]
        self.ends: list[int] = [0]
        self.visits: list[int] = [0]
        self.scale = 1.0

    def add(self, string: bytes) -> None:
        at = 0
        for s in CODE[np.frombuffer(string, np.uint8)].tolist():
            self.visits[at] += 1
            self.times[at][s] = self.times[at].get(s, 0) + 1
            if s not in self.next[at]:
                self.next[at][s] = len(self.next)
                self.next.append({})
                self.times.append({})
                self.ends.append(0)
                self.visits.append(0)
            at = self.next[at][s]
        self.visits[at] += 1
        self.ends[at] += 1

    def agree(self, a: int, b: int, alpha: float) -> bool:
        """Whether the frequencies of state ``a`` and of the tree under ``b`` may come from one state."""
        k = math.sqrt(0.5 * math.log(2 / alpha))
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a] * self.scale, self.visits[b] * self.scale
            room = (1 / math.sqrt(n) + 1 / math.sqrt(m)) * k
            if room >= 1:
                continue  # nothing below can differ by more: counts only fall
            n, m = self.visits[a], self.visits[b]
            if abs(self.ends[a] / n - self.ends[b] / m) > room:
                return False
            ta, tb = self.times[a], self.times[b]
            for s in ta.keys() | tb.keys():
                if abs(ta.get(s, 0) / n - tb.get(s, 0) / m) > room:
                    return False
            todo += [(self.next[a][s], self.next[b][s]) for s in self.next[a].keys() & self.next[b].keys()]
        return True

    def likelihood(self, a: int, b: int) -> float:
        """Log-likelihood of the strings of the tree under ``b`` if they were read from ``a``."""
        total, todo = 0.0, [(a, b)]
        while todo:
            a, b = todo.pop()
            n = self.visits[a] if a >= 0 else 0
            p = lambda c: math.log((c + SMOOTH) / (n + SMOOTH * (END + 1)))  # noqa: E731,B023
            if self.ends[b]:
                total += self.ends[b] * p(self.ends[a] if a >= 0 else 0)
            for s, c in self.times[b].items():
                total += c * p(self.times[a].get(s, 0) if a >= 0 else 0)
                if s in self.next[b]:
                    todo.append((self.next[a].get(s, -1) if a >= 0 else -1, self.next[b][s]))
        return total

    def fold(self, a: int, b: int) -> None:
        """Add the tree under ``b`` to the states reached from ``a``."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for s, c in self.times[b].items():
                self.times[a][s] = self.times[a].get(s, 0) + c
                if s not in self.next[b]:
                    continue
                if s in self.next[a]:
                    todo.append((self.next[a][s], self.next[b][s]))
                else:
                    self.next[a][s] = self.next[b][s]

    def merge_states(self, alpha: float = ALPHA, states: int = 1) -> None:
        """Merge the tree below the first ``states``, which are settled."""
        settled = list(range(states))
        while True:
            known = set(settled)
            open_ = [(self.visits[t], -r, -s, r, s, t) for r in settled for s, t in self.next[r].items() if t not in known]
            if not open_:
                break
            *_, r, s, t = max(open_)
            fits = [a for a in settled if self.agree(a, t, alpha)]
            if fits:
                into = max(fits, key=lambda a: (self.likelihood(a, t), -a))
                self.next[r][s] = into
                self.fold(into, t)
            else:
                settled.append(t)
        number = {q: i for i, q in enumerate(settled)}
        self.next = [{s: number[t] for s, t in self.next[q].items()} for q in settled]
        self.times = [self.times[q] for q in settled]
        self.ends = [self.ends[q] for q in settled]
        self.visits = [self.visits[q] for q in settled]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """(log probabilities: states + 1 by symbols and end, next states); the last state follows unseen symbols."""
        return tables(*self.counts())

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """(counts: states by symbols and end, next states: -1 where none is known)."""
        n = len(self.next)
        times, to = np.zeros((n, END + 1), np.int64), np.full((n, END), -1, np.int64)
        for q in range(n):
            for s, c in self.times[q].items():
                times[q, s] = c
            times[q, END] = self.ends[q]
            for s, t in self.next[q].items():
                to[q, s] = t
        return times, to


def tables(times: np.ndarray, to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log probabilities, next states) of counts; one more state, the last, follows unseen symbols."""
    rows = times + SMOOTH
    lp = np.vstack([np.log(rows / rows.sum(axis=1, keepdims=True)), np.full((1, END + 1), -math.log(END + 1))])
    return lp, np.vstack([np.where(to < 0, len(to), to), np.full((1, END), len(to), np.int64)])


def infer(strings: list[bytes], alpha: float = ALPHA) -> Automaton:
    """The automaton of some strings (in the given order, which does not matter)."""
    a = Automaton()
    for s in strings:
        a.add(s)
    a.merge_states(alpha)
    return a


def resume(times: np.ndarray, to: np.ndarray, tree: list[tuple[int, bytes, dict[int, int]]], alpha: float = ALPHA) -> np.ndarray:
    """The next states after the tree below settled states is merged into them.  ``times`` and ``to`` as in ``counts``, of all
    strings; ``tree``: nodes (state * END + symbol not followed yet, bytes after it, counts by symbol and end)."""
    a, known = Automaton(), len(to)
    a.next = [{s: int(t) for s, t in enumerate(row) if t >= 0} for row in to]
    a.times = [{s: int(c) for s, c in enumerate(row[:END]) if c} for row in times]
    a.ends, a.visits = times[:, END].tolist(), times.sum(axis=1).tolist()
    strings = int(times[:, END].sum()) + sum(int(times[q, s]) for q in range(known) for s in range(END) if to[q, s] < 0)
    a.scale = min(1.0, RESOLUTION / max(1, strings))
    node: dict[tuple[int, bytes], int] = {}
    for at, tail, cells in sorted(tree, key=lambda x: (len(x[1]), x[0], x[1])):
        parent, s = (node[at, tail[:-1]], int(CODE[tail[-1]])) if tail else divmod(at, END)
        a.next[parent][s] = node[at, tail] = len(a.next)
        a.next.append({})
        a.times.append({k: c for k, c in cells.items() if k < END})
        a.ends.append(cells.get(END, 0))
        a.visits.append(sum(cells.values()))
    a.merge_states(alpha, known)
    return a.counts()[1]


def walk(to: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray, wide: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """(state before each byte of the ranges and after their last, one range after the other; length of each range's
    part).  A range ends early at a symbol that its state does not follow: that state is its last."""
    n = end - start
    at = np.concatenate([[0], np.cumsum(n + 1)])
    states, steps = np.zeros(at[-1], np.int64), n.copy()
    order = np.argsort(-n, kind="stable")
    long = int((n > wide).sum())
    table = to.tolist() if long else []
    for i in order[:long]:
        q, path = 0, [0]
        for s in CODE[data[start[i] : end[i]]].tolist():
            q = table[q][s]
            if q < 0:
                break
            path.append(q)
        states[at[i] : at[i] + len(path)], steps[i] = path, len(path) - 1
    live = order[long:]
    state = np.zeros(len(live), np.int64)
    k = 0
    while True:
        go = n[live] > k
        live, state = live[go], state[go]
        if not len(live):
            break
        state = to[state, CODE[data[start[live] + k]]]
        stop = state < 0
        steps[live[stop]] = k
        live, state = live[~stop], state[~stop]
        k += 1
        states[at[live] + k] = state
    keep = np.repeat(steps, n + 1) >= np.arange(at[-1]) - np.repeat(at[:-1], n + 1)
    return states[keep], steps


def symbols_after(states: np.ndarray, steps: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The symbol after each state of ``walk``, ``END`` after a range read to its end."""
    at = np.repeat(start - (np.cumsum(steps + 1) - 1 - steps), steps + 1) + np.arange(len(states))
    out = np.full(len(states), END)
    inner = at < np.repeat(end, steps + 1)
    out[inner] = CODE[data[at[inner]]]
    return out


def left_out_likelihood(times: np.ndarray, to: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Log-likelihood of each range under the counts without it; all were counted."""
    states, steps = walk(to, data, start, end)
    which = np.repeat(np.arange(len(start)), steps + 1)
    symbol = symbols_after(states, steps, data, start, end)

    def own(cell: np.ndarray, cells: int) -> np.ndarray:
        _, back, n = np.unique(which * cells + cell, return_inverse=True, return_counts=True)
        return n[back]

    c = times[states, symbol] - own(states * (END + 1) + symbol, times.size)
    v = times.sum(axis=1)[states] - own(states, len(times))
    return np.bincount(which, np.log((c + SMOOTH) / (v + SMOOTH * (END + 1))), len(start))


def log_likelihood(tables: tuple[np.ndarray, np.ndarray], data: np.ndarray, start: np.ndarray, end: np.ndarray,
                   wide: int = 512) -> np.ndarray:
    """Log-likelihood of each byte range of ``data``: ranges of up to ``wide`` bytes step together, longer
    ones one by one."""
    lp, to = tables
    out = np.zeros(len(start))
    n = end - start
    order = np.argsort(-n, kind="stable")
    long = int((n > wide).sum())
    for i in order[:long]:
        rows, state, total = lp.tolist(), 0, 0.0
        steps = to.tolist()
        for s in CODE[data[start[i] : end[i]]].tolist():
            total += rows[state][s]
            state = steps[state][s]
        out[i] = total + rows[state][END]
    order = order[long:]
    first, length = start[order], n[order]
    state, total = np.zeros(len(order), np.int64), np.zeros(len(order))
    live = len(order)
    for k in range(int(length[0]) if live else 0):
        live = int(np.searchsorted(-length, -k, side="left"))
        s = CODE[data[first[:live] + k]]
        total[:live] += lp[state[:live], s]
        state[:live] = to[state[:live], s]
    out[order] = total + lp[state, END]
    return out

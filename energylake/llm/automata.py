"""Regular expressions to minimal byte automata, and vectorised scans with them."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Sequence
from dataclasses import dataclass
from operator import or_

import numpy as np

ANY = frozenset(range(256))
LANE = 256
FEW = 8


class Parser:
    """Concatenation, ``|``, groups, classes, ``? * +`` and ``{m,n}`` over ASCII, as a tree.

    Nodes are ("set", bytes), ("cat", parts), ("or", parts), ("loop", node) for zero or more.
    """

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def parse(self):
        node = self.either()
        if self.at < len(self.text):
            raise ValueError(f"cannot read {self.text!r} at {self.at}")
        return node

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def either(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("or", parts)

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.single()))
        return ("cat", parts)

    def repeated(self, node):
        while self.peek() and self.peek() in "?*+{":
            mark = self.take()
            if mark == "{":
                end = self.text.index("}", self.at)
                low, _, high = self.text[self.at:end].partition(",")
                exact = "," not in self.text[self.at:end]
                self.at = end + 1
                least, most = int(low), int(low) if exact else int(high) if high else None
            else:
                least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}[mark]
            tail = [("loop", node)] if most is None else [("or", [("cat", []), node])] * (most - least)
            node = ("cat", [node] * least + tail)
        return node

    def single(self):
        c = self.take()
        if c == "(":
            node = self.either()
            if self.take() != ")":
                raise ValueError("unbalanced group")
            return node
        if c == "[":
            return ("set", self.members())
        return ("set", frozenset([self.code(c)]))

    def code(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def members(self) -> frozenset[int]:
        flip = self.peek() == "^"
        if flip:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            low = self.code(self.take())
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] != "]":
                self.take()
                found.update(range(low, self.code(self.take()) + 1))
            else:
                found.add(low)
        self.take()
        return ANY - found if flip else frozenset(found)


def reverse(node):
    kind, body = node
    if kind == "cat":
        return (kind, [reverse(x) for x in reversed(body)])
    if kind == "or":
        return (kind, [reverse(x) for x in body])
    return (kind, reverse(body)) if kind == "loop" else node


class Nfa:
    """States with byte-set steps and free steps, built from trees."""

    def __init__(self):
        self.steps: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node, start: int) -> int:
        """Append the node after ``start``; returns the state in which it ends."""
        kind, body = node
        if kind == "set":
            end = self.state()
            self.steps[start].append((body, end))
            return end
        if kind == "cat":
            for part in body:
                start = self.add(part, start)
            return start
        if kind == "or":
            end = self.state()
            for part in body:
                self.free[self.add(part, self._after(start))].append(end)
            return end
        hub = self._after(start)
        self.free[self.add(body, hub)].append(hub)
        return self._after(hub)

    def _after(self, start: int) -> int:
        new = self.state()
        self.free[start].append(new)
        return new

    def closure(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Dfa:
    """``step[state * classes + byte_class]`` is the next state times ``classes``.

    State 0 is the start.  ``accept`` has, by state, the bits of the patterns that end there;
    ``dead`` is the state times ``classes`` that nothing leaves, or -1.
    """

    step: np.ndarray
    byte_class: np.ndarray
    accept: np.ndarray
    classes: int
    dead: int

    def __post_init__(self):
        self.steps, self.kinds = self.step.tolist(), self.byte_class.tolist()
        self.ends = np.repeat(self.accept, self.classes).tolist()
        table = self.step.reshape(-1, self.classes)
        reset = (table == 0).all(axis=0)
        self.resets = reset[self.byte_class]  # bytes that lead to the start from everywhere

    def longest(self, data: bytes, start: int, stop: int, way: int = 1) -> int | None:
        """Farthest end of a match that begins at ``start``, walking towards ``stop``."""
        state, best = 0, start if self.ends[0] else None
        for i in range(start, stop, way):
            state = self.steps[state + self.kinds[data[i if way > 0 else i - 1]]]
            if state == self.dead:
                break
            if self.ends[state]:
                best = i + way
        return best

    def scan(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends (exclusive) of matches and the bits of their patterns, in one pass.

        The bytes are cut after reset bytes into lanes that advance together, one byte of
        each lane a step; the last few long lanes go on alone.
        """
        n = len(data)
        if not n:
            return np.empty(0, np.int64), np.empty(0, self.accept.dtype)
        kind = self.byte_class[data]
        cuts = np.flatnonzero(self.resets[data]) + 1
        wanted = np.searchsorted(cuts, np.arange(LANE, n, LANE))
        starts = np.unique(np.append(0, cuts[wanted[wanted < len(cuts)]]))
        starts = starts[starts < n]
        length = np.diff(np.append(starts, n))
        order = np.argsort(-length, kind="stable")
        starts, length = starts[order], length[order]
        state = np.zeros(len(starts), np.int32)
        accept = np.repeat(self.accept, self.classes)
        at, bits, t = [], [], 0
        while True:
            live = int(np.searchsorted(-length, -t, side="left"))  # lanes longer than t
            if live <= FEW:
                break
            state = self.step[state[:live] + kind[starts[:live] + t]]
            got = accept[state]
            if got.any():
                hit = np.flatnonzero(got)
                at.append(starts[hit] + t + 1)
                bits.append(got[hit])
            t += 1
        for lane in range(live):
            s, alone, marks = int(state[lane]), [], []
            for i, k in enumerate(kind[starts[lane] + t:starts[lane] + length[lane]].tolist()):
                s = self.steps[s + k]
                if self.ends[s]:
                    alone.append(i)
                    marks.append(self.ends[s])
            at.append(np.array(alone, np.int64) + starts[lane] + t + 1)
            bits.append(np.array(marks, accept.dtype))
        if not at:
            return np.empty(0, np.int64), np.empty(0, accept.dtype)
        at, bits = np.concatenate(at), np.concatenate(bits)
        order = np.argsort(at, kind="stable")
        return at[order], bits[order]


def compile_dfa(trees: Sequence, anywhere: bool) -> Dfa:
    """Minimal automaton of all patterns together; ``anywhere``: matches may begin at any byte."""
    nfa = Nfa()
    start = nfa.state()
    if anywhere:
        nfa.steps[start].append((ANY, start))
    final: dict[int, int] = {}
    for bit, tree in enumerate(trees):
        final[nfa.add(tree, nfa._after(start))] = 1 << bit
    sets = {s for steps in nfa.steps for s, _ in steps}
    signature = {}
    byte_class = np.array([signature.setdefault(
        tuple(b in s for s in sets), len(signature)) for b in range(256)], np.int32)
    sample = [int(np.flatnonzero(byte_class == c)[0]) for c in range(len(signature))]
    # sets of states as bits of a number, less those that have neither a byte step nor an end
    counts = [bool(steps) or s in final for s, steps in enumerate(nfa.steps)]
    closed = [sum(1 << t for t in nfa.closure([s]) if counts[t]) for s in range(len(counts))]
    leads = [[0] * len(sample) for _ in counts]
    for s, steps in enumerate(nfa.steps):
        for c, b in enumerate(sample):
            for chars, t in steps:
                if b in chars:
                    leads[s][c] |= closed[t]
    # subset construction
    number, rows, todo, ends = {closed[start]: 0}, [], [closed[start]], []
    for states in todo:
        row, end, rest = [0] * len(sample), 0, states
        while rest:
            low = rest & -rest
            s = low.bit_length() - 1
            rest ^= low
            end |= final.get(s, 0)
            row = list(map(or_, row, leads[s]))
        for target in row:
            if target not in number:
                number[target] = len(number)
                todo.append(target)
        rows.append([number[t] for t in row])
        ends.append(end)
    table, accept = np.array(rows, np.int64), np.array(ends, np.int64)
    # minimisation: split blocks by where their states lead, told apart by a hash, until none splits
    mix = np.random.default_rng(1).integers(1, 1 << 63, len(sample) + 1, np.uint64) | np.uint64(1)
    block = np.unique(accept, return_inverse=True)[1]
    while True:
        mark = (block.astype(np.uint64) + np.uint64(1)) * mix[-1]
        for c in range(len(sample)):
            mark ^= (mark >> np.uint64(29)) + (block[table[:, c]].astype(np.uint64) + np.uint64(1)) * mix[c]
        finer = np.unique(mark, return_inverse=True)[1]
        if finer.max() == block.max():
            break
        block = finer
    renamed = np.full(block.max() + 1, -1)
    order = np.unique(block, return_index=True)[1]
    rank = np.argsort(order)  # blocks by their first state, so that the start is 0
    renamed[rank] = np.arange(len(rank))
    keep = np.sort(order)
    step = renamed[block[table[keep]]]
    accepts = accept[keep]
    lost = np.flatnonzero((step == np.arange(len(step))[:, None]).all(axis=1) & (accepts == 0))
    classes = len(signature)
    dead = int(lost[0]) * classes if len(lost) and not anywhere else -1
    return Dfa((step * classes).astype(np.int32).ravel(), byte_class, accepts, classes, dead)


class Pattern:
    """One pattern's anchored automata, forwards and backwards."""

    def __init__(self, pattern: str):
        self.tree = Parser(pattern).parse()
        self.forward = compile_dfa([self.tree], anywhere=False)
        self.backward = compile_dfa([reverse(self.tree)], anywhere=False)

    def matches(self, data: bytes, ends: Sequence[int]) -> list[tuple[int, int]]:
        """Leftmost-longest matches that do not overlap, from the ends a scan has found.

        From the next end the backward automaton finds the earliest start after the last
        match, and the forward one the farthest end from there.  That is leftmost as long as
        a match that begins earlier has an end no later than the first end seen.
        """
        out, done, i = [], 0, 0
        while i < len(ends):
            start = self.backward.longest(data, ends[i], done, -1)
            if start is None:
                i += 1
                continue
            done = self.forward.longest(data, start, len(data))
            out.append((start, done))
            i = bisect_right(ends, done)
        return out

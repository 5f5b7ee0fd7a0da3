"""Regular expressions compiled to minimal deterministic automata over bytes.

parse() reads a subset of the usual syntax (literals, escapes, classes, groups, alternation, ?, *, +, {m}, {m,}, {m,n},
and (?i:...) for ASCII letters) into a nondeterministic automaton by Thompson's construction. compile_rules() makes one
deterministic automaton of many rules by subset construction over byte classes, minimises it by partition refinement and
numbers its states so that accepting ones come last.
"""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np

ALL = (1 << 256) - 1


class Nfa:
    def __init__(self):
        self.moves: list[tuple[int, int]] = []  # of a state: (set of bytes as a bit mask, next state), or (0, -1)
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.moves.append((0, -1))
        self.free.append([])
        return len(self.moves) - 1


class _Parser:
    def __init__(self, pattern: str, nfa: Nfa):
        self.p, self.i, self.n, self.fold = pattern, 0, nfa, False

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def alternatives(self):
        branches = [self.sequence()]
        while self.peek() == "|":
            self.i += 1
            branches.append(self.sequence())
        return ("or", branches) if len(branches) > 1 else branches[0]

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("seq", parts)

    def repeated(self, node):
        while (c := self.peek()) and c in "?*+{":
            self.i += 1
            low, high = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(c, (0, 0))
            if c == "{":
                end = self.p.index("}", self.i)
                a, comma, b = self.p[self.i : end].partition(",")
                low, high = int(a), (int(b) if b else None) if comma else int(a)
                self.i = end + 1
            node = ("rep", node, low, high)
        return node

    def atom(self):
        c = self.p[self.i]
        self.i += 1
        if c == "(":
            was = self.fold
            for mark, fold in (("?i:", True), ("?:", was)):
                if self.p.startswith(mark, self.i):
                    self.i, self.fold = self.i + len(mark), fold
            node = self.alternatives()
            if self.peek() != ")":
                raise ValueError(f"unclosed group in {self.p}")
            self.i, self.fold = self.i + 1, was
            return node
        if c == "[":
            return ("set", self.byte_class())
        if c == ".":
            return ("set", ALL & ~(1 << 10))
        return ("set", self.folded(1 << (self.escape() if c == "\\" else self.literal(c))))

    def literal(self, c: str) -> int:
        if ord(c) > 127:
            raise ValueError("write bytes beyond ASCII as \\xHH")
        return ord(c)

    def escape(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c == "x":
            self.i += 2
            return int(self.p[self.i - 2 : self.i], 16)
        return {"n": 10, "r": 13, "t": 9}.get(c, ord(c))

    def folded(self, mask: int) -> int:
        if self.fold:
            for a in range(65, 91):
                if mask >> a & 1 or mask >> (a + 32) & 1:
                    mask |= 1 << a | 1 << (a + 32)
        return mask

    def byte_class(self) -> int:
        negated, mask, first = self.peek() == "^", 0, True
        self.i += negated
        while first or self.peek() != "]":
            first, low = False, self.member()
            high = low
            if self.peek() == "-" and self.p[self.i + 1] != "]":
                self.i += 1
                high = self.member()
            for b in range(low, high + 1):
                mask |= 1 << b
        self.i += 1
        mask = self.folded(mask)
        return ALL & ~mask if negated else mask

    def member(self) -> int:
        c = self.p[self.i]
        self.i += 1
        return self.escape() if c == "\\" else self.literal(c)


def _build(n: Nfa, node, start: int) -> int:
    """Adds node from start on; its end state."""
    kind = node[0]
    if kind == "set":
        end = n.state()
        middle = n.state()
        n.free[start].append(middle)
        n.moves[middle] = (node[1], end)
        return end
    if kind == "seq":
        for x in node[1]:
            start = _build(n, x, start)
        return start
    if kind == "or":
        end = n.state()
        for x in node[1]:
            begin = n.state()
            n.free[start].append(begin)
            n.free[_build(n, x, begin)].append(end)
        return end
    _, inner, low, high = node
    for _ in range(low):
        start = _build(n, inner, start)
    if high is None:
        loop, end = n.state(), n.state()
        n.free[start].append(loop)
        n.free[loop].append(end)
        n.free[_build(n, inner, loop)].append(loop)
        return end
    end = n.state()
    for _ in range(high - low):
        n.free[start].append(end)
        start = _build(n, inner, start)
    n.free[start].append(end)
    return end


@dataclass(frozen=True)
class Dfa:
    """classes: of each byte. next: state * n_classes + class -> state. States from accepting on accept the rules whose
    bits accepts has. dead: the state that nothing leaves, or -1."""

    classes: np.ndarray
    n_classes: int
    next: np.ndarray
    start: int
    accepting: int
    accepts: list[int]
    dead: int

    @property
    def n_states(self) -> int:
        return len(self.next) // self.n_classes

    def resetting(self) -> np.ndarray:
        """Of each byte: whether it takes every state to the start."""
        by_class = (self.next.reshape(-1, self.n_classes) == self.start).all(0)
        return by_class[self.classes]


def compile_rules(patterns: list[str], anywhere: bool) -> Dfa:
    """anywhere: rules may begin at any byte; else at the first."""
    n = Nfa()
    root, finals = n.state(), {}
    for bit, p in enumerate(patterns):
        parser = _Parser(p, n)
        node = parser.alternatives()
        if parser.i < len(p):
            raise ValueError(f"unexpected {p[parser.i :]!r} in {p}")
        begin = n.state()
        n.free[root].append(begin)
        finals[_build(n, node, begin)] = 1 << bit
    # bytes that no move tells apart are one class
    masks = sorted({m for m, to in n.moves if to >= 0})
    signature = [tuple(m >> b & 1 for m in masks) for b in range(256)]
    ids = {s: i for i, s in enumerate(dict.fromkeys(signature))}
    classes = np.array([ids[s] for s in signature], np.uint8)
    sample = [int(np.flatnonzero(classes == c)[0]) for c in range(len(ids))]

    def closure(states) -> frozenset:
        todo, seen = list(states), set(states)
        while todo:
            for t in n.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if n.moves[s][1] >= 0 or s in finals)

    base = closure([root])
    found, table, queue = {base: 0}, [], deque([base])
    while queue:
        states = queue.popleft()
        moves = [n.moves[s] for s in states if n.moves[s][1] >= 0]
        row = []
        for b in sample:
            to = closure({t for m, t in moves if m >> b & 1})
            to = to | base if anywhere else to
            if to not in found:
                found[to] = len(found)
                queue.append(to)
            row.append(found[to])
        table.append(row)
    step = np.array(table, np.int64)
    accepts = np.array([sum({finals[s] for s in states if s in finals}) for states in found], np.int64)

    # partition refinement: states stay together while they accept alike and move to the same parts
    part = np.unique(accepts, return_inverse=True)[1].reshape(-1)
    while True:
        finer = np.unique(np.column_stack([part, part[step]]), axis=0, return_inverse=True)[1].reshape(-1)
        if finer.max() == part.max():
            break
        part = finer
    k = int(part.max()) + 1
    member = np.zeros(k, np.int64)
    member[part] = np.arange(len(part))
    order = np.argsort(accepts[member] > 0, kind="stable")
    place = np.empty(k, np.int64)
    place[order] = np.arange(k)
    step, accepts = place[part[step[member[order]]]], accepts[member[order]]
    accepting = int((accepts == 0).sum())
    dead = [s for s in range(accepting) if (step[s] == s).all()]
    return Dfa(classes, len(sample), step.astype(np.int32).reshape(-1), int(place[part[0]]), accepting, accepts.tolist(), dead[0] if dead and not anywhere else -1)


def scan(dfa: Dfa, data: np.ndarray, offsets: np.ndarray, stride: int = 512, few: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """One pass of dfa over texts laid end to end: positions of the bytes after which it accepts, and the states then.

    Texts are cut into lanes behind bytes that always reset the automaton, about every stride bytes, and all lanes step
    together; when few are left, each goes on alone.
    """
    starts = offsets[:-1][np.diff(offsets) > 0]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    resets = np.flatnonzero(dfa.resetting()[data]) + 1
    if len(resets):
        at = np.searchsorted(resets, np.arange(stride, len(data), stride))
        resets = resets[at[at < len(resets)]]
    starts = np.unique(np.concatenate([starts, resets[resets < len(data)]]))
    lengths = np.diff(np.append(starts, len(data)))
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    n, move, classes = dfa.n_classes, dfa.next, dfa.classes[data].astype(np.int32)
    state = np.full(len(starts), dfa.start, np.int32)
    hits, states = [], []
    live, i = len(starts), 0
    active = np.searchsorted(-lengths, -np.arange(1, int(lengths[0]) + 1), "right").tolist()  # lanes longer than i
    position = starts.copy()
    while i < len(active) and (live := active[i]) > few:
        s = state[:live]
        s *= n
        s += classes[position[:live]]
        np.take(move, s, out=s)
        if s.max() >= dfa.accepting:
            got = np.flatnonzero(s >= dfa.accepting)
            hits.append(position[got].copy())
            states.append(s[got].copy())
        position[:live] += 1
        i += 1
    if i < len(active):
        flat = move.tolist()
        for lane in range(active[i]):
            s, at = int(state[lane]), int(position[lane])
            for p, c in enumerate(classes[at : int(starts[lane] + lengths[lane])].tolist(), at):
                s = flat[s * n + c]
                if s >= dfa.accepting:
                    hits.append(np.array([p]))
                    states.append(np.array([s], np.int32))
    if not hits:
        return np.zeros(0, np.int64), np.zeros(0, np.int32)
    hits, states = np.concatenate(hits), np.concatenate(states)
    order = np.argsort(hits, kind="stable")
    return hits[order], states[order]


def longest_matches(dfa: Dfa, data: bytes) -> list[tuple[int, int, int]]:
    """Leftmost-longest matches of an anchored automaton, not overlapping: start, end, and the first end that accepts.

    A walk leaves behind the pairs of position and state from which it came to no acceptance; a later walk that meets
    one stops there. So each pair is walked once, and time is in proportion to the length of data.
    """
    move, n, out, i, size = _flat(dfa), dfa.n_classes, [], 0, len(data)
    kinds = dfa.classes[np.frombuffer(data, np.uint8)]
    begins = dfa.next[dfa.start * n : (dfa.start + 1) * n] != dfa.dead
    starts, classes = np.flatnonzero(begins[kinds]).tolist(), kinds.tolist()
    vain: set[int] = set()
    for i_ in starts:
        if i_ < i:
            continue
        s, first, last, j, trail = dfa.start, -1, -1, i_, []
        while j < size:
            s = move[s * n + classes[j]]
            if s == dfa.dead:
                break
            j += 1
            if s >= dfa.accepting:
                last = j
                first = j if first < 0 else first
                if trail:
                    trail = []
            else:
                at = s * (size + 1) + j
                if at in vain:
                    break
                trail.append(at)
        vain.update(trail)
        if last > i_:
            out.append((i_, last, first))
            i = last
    return out


_flats: dict[int, tuple[Dfa, list[int]]] = {}


def _flat(dfa: Dfa) -> list[int]:
    if id(dfa) not in _flats:
        _flats[id(dfa)] = (dfa, dfa.next.tolist())
    return _flats[id(dfa)][1]

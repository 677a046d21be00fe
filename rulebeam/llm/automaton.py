"""Several regular expressions as one deterministic automaton over bytes.

Patterns are parsed to trees, made into one nondeterministic automaton, turned into a
deterministic one by subset construction over classes of bytes that no pattern tells
apart, and minimised by partition refinement. The result is an array of transitions
and, per state, a bit mask of the patterns that end there.

``scan`` runs the array over a long buffer in one pass: the buffer is cut into
lanes that step together, each from an assumed state; lanes whose assumption turns out
wrong are stepped again until their states meet the earlier ones. The states are
those of a plain byte loop.

Syntax: literals, ``\\xHH`` and escaped signs, ``[...]`` classes with ranges and negation, ``(...)``, ``|``,
``?``, ``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``; ASCII only. ``(?i)`` in front: letters in either case.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LANE = 256          # bytes of one lane
WINDOW = 4 << 20    # bytes scanned at once


class _Parser:
    """A pattern as a tree of ("set", bytes), ("cat", parts), ("alt", parts), ("rep", part, least, most)."""

    def __init__(self, pattern: str):
        self.either = pattern.startswith("(?i)")
        self.text = pattern[4:] if self.either else pattern
        self.at = 0
        if not self.text.isascii():
            raise ValueError("patterns are ASCII")

    def tree(self):
        found = self._alternatives()
        if self.at < len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at}")
        return found

    def _peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def _alternatives(self):
        parts = [self._sequence()]
        while self._peek() == "|":
            self.at += 1
            parts.append(self._sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def _sequence(self):
        parts = []
        while self._peek() and self._peek() not in "|)":
            parts.append(self._repeated(self._atom()))
        return ("cat", parts)

    def _repeated(self, part):
        while self._peek() and self._peek() in "?*+{":
            sign = self._peek()
            self.at += 1
            if sign == "{":
                stop = self.text.index("}", self.at)
                least, comma, most = self.text[self.at:stop].partition(",")
                self.at = stop + 1
                bounds = (int(least), int(most) if most else (None if comma else int(least)))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[sign]
            part = ("rep", part, *bounds)
        return part

    def _atom(self):
        sign = self._peek()
        if sign == "(":
            self.at += 1
            inner = self._alternatives()
            if self._peek() != ")":
                raise ValueError("unclosed group")
            self.at += 1
            return inner
        if sign == "[":
            return self._class()
        if sign in "?*+{":
            raise ValueError(f"nothing to repeat at {self.at}")
        return ("set", self._cased({self._code()}))

    def _code(self) -> int:
        sign = self._peek()
        self.at += 1
        if sign != "\\":
            return ord(sign)
        sign = self._peek()
        self.at += 1
        if sign == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        if not sign or sign.isalnum():
            raise ValueError(f"unknown escape \\{sign}")
        return ord(sign)

    def _class(self):
        self.at += 1
        negated = self._peek() == "^"
        self.at += negated
        found: set[int] = set()
        while self._peek() != "]":
            low = self._code()
            if self._peek() == "-" and self.text[self.at + 1:self.at + 2] != "]":
                self.at += 1
                found.update(range(low, self._code() + 1))
            else:
                found.add(low)
        self.at += 1
        found = self._cased(found)
        return ("set", frozenset(range(256)) - found if negated else found)

    def _cased(self, codes) -> frozenset:
        if not self.either:
            return frozenset(codes)
        return frozenset(c for code in codes for c in {code, ord(chr(code).lower()), ord(chr(code).upper())}
                         if c < 128) if all(c < 128 for c in codes) else frozenset(codes)


def _reversed(tree):
    kind = tree[0]
    if kind == "cat":
        return ("cat", [_reversed(p) for p in reversed(tree[1])])
    if kind == "alt":
        return ("alt", [_reversed(p) for p in tree[1]])
    if kind == "rep":
        return ("rep", _reversed(tree[1]), tree[2], tree[3])
    return tree


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []             # moves without a byte
        self.moves: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.moves.append([])
        return len(self.free) - 1

    def add(self, tree, source: int) -> int:
        """The state reached from ``source`` by ``tree``."""
        kind = tree[0]
        if kind == "set":
            target = self.state()
            self.moves[source].append((tree[1], target))
            return target
        if kind == "cat":
            for part in tree[1]:
                source = self.add(part, source)
            return source
        if kind == "alt":
            target = self.state()
            for part in tree[1]:
                entry = self.state()
                self.free[source].append(entry)
                self.free[self.add(part, entry)].append(target)
            return target
        _, part, least, most = tree
        for _ in range(least):
            source = self.add(part, source)
        if most is None:
            loop = self.state()
            self.free[source].append(loop)
            self.free[self.add(part, loop)].append(loop)
            target = self.state()
            self.free[loop].append(target)
            return target
        target = self.state()
        self.free[source].append(target)
        for _ in range(most - least):
            source = self.add(part, source)
            self.free[source].append(target)
        return target

    def closure(self, states) -> frozenset:
        seen = set(states)
        todo = list(seen)
        while todo:
            for nxt in self.free[todo.pop()]:
                if nxt not in seen:
                    seen.add(nxt)
                    todo.append(nxt)
        return frozenset(seen)


@dataclass
class Automaton:
    """``table[state, class]``: next state; ``codes[byte]``: class; ``masks[state]``: patterns
    that end here. The last class is a break: it leads to ``start`` from everywhere."""

    table: np.ndarray
    codes: np.ndarray
    masks: np.ndarray
    start: int

    @property
    def break_code(self) -> int:
        return self.table.shape[1] - 1

    def rows(self) -> list[list[int]]:
        """Next states by byte, -1 where no pattern can end any more (for walks from one place)."""
        ends = self.masks > 0
        while True:  # states that can still reach an end
            more = ends | ends[self.table[:, :-1]].any(axis=1)
            if (more == ends).all():
                break
            ends = more
        by_byte = self.table[:, self.codes]
        return np.where(ends[by_byte], by_byte, -1).tolist()


def build(patterns: list[str], backwards: bool = False, anywhere: bool = False) -> Automaton:
    """One minimal automaton for ``patterns``; ``backwards``: for text read from its
    end; ``anywhere``: a pattern may begin at any byte."""
    nfa, first, ends = _Nfa(), [], {}
    for i, pattern in enumerate(patterns):
        tree = _Parser(pattern).tree()
        source = nfa.state()
        first.append(source)
        ends[nfa.add(_reversed(tree) if backwards else tree, source)] = i
    sets = sorted({s for moves in nfa.moves for s, _ in moves}, key=sorted)
    member = np.array([[b in s for s in sets] for b in range(256)]).reshape(256, len(sets))
    kinds, codes = np.unique(member, axis=0, return_inverse=True)
    sample = [int(np.flatnonzero(codes.ravel() == k)[0]) for k in range(len(kinds))]

    begin = nfa.closure(first)
    ids, todo, table = {begin: 0}, [begin], []
    while todo:
        current = todo.pop(0)
        row = []
        for byte in sample:
            reached = nfa.closure(t for s in current for allowed, t in nfa.moves[s] if byte in allowed)
            if anywhere:
                reached |= begin
            if reached not in ids:
                ids[reached] = len(ids)
                todo.append(reached)
            row.append(ids[reached])
        table.append(row)
    masks = np.zeros(len(ids), np.int64)
    for states, i in ids.items():
        masks[i] = sum(1 << ends[s] for s in states if s in ends)
    return _minimal(np.array(table), codes.ravel(), masks)


def _minimal(table, codes, masks) -> Automaton:
    part = np.unique(masks, return_inverse=True)[1].ravel()
    while True:
        _, keep, finer = np.unique(np.c_[part, part[table]], axis=0, return_index=True, return_inverse=True)
        finer = finer.ravel()
        if len(keep) == part.max() + 1:
            break
        part = finer
    first = np.unique(part, return_index=True)[1]
    rows, start = part[table][first], int(part[0])
    return Automaton(np.c_[rows, np.full(len(rows), start)], codes.astype(np.uint8), masks[first], start)


def scan(machine: Automaton, codes: np.ndarray, backwards: bool = False):
    """Where patterns end in a buffer of classes: (positions ascending in reading order, masks).

    With ``backwards`` the buffer is read from its end; positions are those of the
    buffer in either case. Memory is bounded by ``WINDOW``, apart from the finds."""
    width = machine.table.shape[1]
    table = (machine.table * width).ravel().astype(np.intp)
    marks = np.repeat(machine.masks, width)
    n, state = len(codes), machine.start * width
    for lo in range(0, n, WINDOW):
        piece = codes[n - min(lo + WINDOW, n):n - lo][::-1] if backwards else codes[lo:lo + WINDOW]
        states, state = _lanes(table, piece, state, machine.start * width, machine.break_code)
        found = marks.take(states)
        step, lane = np.nonzero(found)
        at = lane * LANE + step
        good = at < len(piece)
        at, mask = at[good], found[step, lane][good]
        order = np.argsort(at, kind="stable")
        at = at[order] + lo
        yield (n - 1 - at if backwards else at), mask[order]


def _lanes(table, piece, entry: int, guess: int, pad: int):
    """States after each byte of a piece, as [step, lane], and the state at its end."""
    lanes = -(-len(piece) // LANE)
    full = np.full(lanes * LANE, pad, np.uint8)
    full[:len(piece)] = piece
    steps = np.ascontiguousarray(full.reshape(lanes, LANE).T)
    out = np.empty((LANE, lanes), np.int32)
    begun = np.full(lanes, guess, np.intp)
    begun[0] = entry
    state = begun.copy()
    for i in range(LANE):
        state = table.take(state + steps[i])
        out[i] = state
    while True:
        real = np.r_[entry, out[-1, :-1]]
        wrong = np.flatnonzero(real != begun)
        if not len(wrong):
            break
        state = real[wrong].astype(np.intp)
        begun[wrong] = state
        for i in range(LANE):
            state = table.take(state + steps[i, wrong])
            if (state == out[i, wrong]).all():
                break
            out[i, wrong] = state
    last = (len(piece) - 1) % LANE if len(piece) else 0
    return out, int(out[last, -1])

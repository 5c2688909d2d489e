"""Regexes compiled to minimal deterministic automata over bytes.

Syntax: literals, ``.`` (any byte but line feed), ``[...]`` with ranges and ``^``, ``( )``, ``|``, ``? * + {m} {m,} {m,n}``
and escapes ``\\xHH``, ``\\n``, ``\\t`` and ``\\`` before a literal. A rule becomes a nondeterministic automaton with empty moves; sets of
its states become states of a deterministic one (subset construction), of which those that no input tells apart are
merged (partition refinement). Bytes that no rule tells apart share a column while building; the finished arrays have
all 256.
"""

from __future__ import annotations

from dataclasses import dataclass

Edges = list[list[tuple[frozenset[int] | None, int]]]


class Nfa:
    def __init__(self) -> None:
        self.edges: Edges = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def add(self, a: int, on: frozenset[int] | None, b: int) -> None:
        self.edges[a].append((on, b))

    def rule(self, pattern: str, any_case: bool = False) -> tuple[int, int]:
        """Adds a rule; its first and last state."""
        at = 0

        def fold(x: set[int]) -> frozenset[int]:
            return frozenset(x | {c ^ 32 for c in x if chr(c & ~32) in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} if any_case else x)

        def char() -> int:
            nonlocal at
            c = pattern[at]
            at += 1
            if c != "\\":
                return ord(c)
            c = pattern[at]
            at += 1
            if c == "x":
                at += 2
                return int(pattern[at - 2 : at], 16)
            return {"n": 10, "t": 9}.get(c, ord(c))

        def members() -> set[int]:
            nonlocal at
            negated, out, first = pattern[at] == "^", set(), True
            at += negated
            while first or pattern[at] != "]":
                first, a = False, char()
                if pattern[at] == "-" and pattern[at + 1] != "]":
                    at += 1
                    out |= set(range(a, char() + 1))
                else:
                    out.add(a)
            at += 1
            return set(range(256)) - out if negated else out

        def atom() -> tuple[int, int]:
            nonlocal at
            if pattern[at] == "(":
                at += 1
                pair = choice()
                at += 1
                return pair
            if pattern[at] == "[":
                at += 1
                on = members()
            elif pattern[at] == ".":
                at += 1
                on = set(range(256)) - {10}
            else:
                on = {char()}
            a, b = self.state(), self.state()
            self.add(a, fold(on), b)
            return a, b

        def again(begin: int) -> tuple[int, int]:
            """One more copy of the atom that begins there."""
            nonlocal at
            stay, at = at, begin
            pair = atom()
            at = stay
            return pair

        def repeat() -> tuple[int, int]:
            nonlocal at
            begin = at
            a, b = atom()
            if at >= len(pattern) or pattern[at] not in "?*+{":
                return a, b
            sign = pattern[at]
            if sign == "{":
                low, _, high = pattern[at + 1 : pattern.index("}", at)].partition(",")
                least, most = int(low), int(high or 0) if "," in pattern[at : pattern.index("}", at)] else int(low)
                at = pattern.index("}", at) + 1
            else:
                least, most = {"?": (0, 1), "*": (0, 0), "+": (1, 0)}[sign]
                at += 1
            stay, first, last, copies = at, self.state(), None, [(a, b)]
            copies += [again(begin) for _ in range(max(least, most, 1) - 1 + (not most))]
            at, last = stay, first
            end = self.state()
            for i, (x, y) in enumerate(copies):
                if i >= least:
                    self.add(last, None, end)
                self.add(last, None, x)
                last = y
            self.add(last, None, end)
            if not most:
                self.add(last, None, copies[-1][0])
            return first, end

        def sequence() -> tuple[int, int]:
            first = last = self.state()
            while at < len(pattern) and pattern[at] not in "|)":
                a, b = repeat()
                self.add(last, None, a)
                last = b
            return first, last

        def choice() -> tuple[int, int]:
            nonlocal at
            first, end = self.state(), self.state()
            while True:
                a, b = sequence()
                self.add(first, None, a)
                self.add(b, None, end)
                if at >= len(pattern) or pattern[at] != "|":
                    return first, end
                at += 1

        return choice()

    def reversed(self) -> Nfa:
        out = Nfa()
        out.edges = [[] for _ in self.edges]
        for a, moves in enumerate(self.edges):
            for on, b in moves:
                out.add(b, on, a)
        return out


@dataclass(frozen=True)
class Dfa:
    """State s moves on byte c to move[s + c]; states are multiples of 256, from first_accepting on they accept."""

    move: list[int]
    start: int
    first_accepting: int
    #: Labels that a state accepts, by state // 256.
    accepts: list[tuple[int, ...]]
    #: The state without a way to accept, or -1.
    dead: int

    def __setstate__(self, d: dict) -> None:
        own: dict[int, int] = {}
        self.__dict__.update(d | {"move": [own.setdefault(x, x) for x in d["move"]]})


def deterministic(nfa: Nfa, starts: list[int], accepting: dict[int, int], anywhere: bool = False) -> Dfa:
    """anywhere: a match may begin at any byte. accepting: label of a state."""
    if anywhere:
        root = nfa.state()
        nfa.add(root, frozenset(range(256)), root)
        for s in starts:
            nfa.add(root, None, s)
        starts = [root]

    def closed(states: frozenset[int] | set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for on, b in nfa.edges[todo.pop()]:
                if on is None and b not in seen:
                    seen.add(b)
                    todo.append(b)
        return frozenset(s for s in seen if s in accepting or any(on is not None for on, _ in nfa.edges[s]))

    used = {on for moves in nfa.edges for on, _ in moves if on is not None}
    alike: dict[tuple[bool, ...], list[int]] = {}
    for c in range(256):
        alike.setdefault(tuple(c in on for on in used), []).append(c)
    columns = list(alike.values())
    first = closed(set(starts))
    number, order, table = {first: 0}, [first], []
    while len(table) < len(order):
        row = []
        for col in columns:
            to = closed({b for s in order[len(table)] for on, b in nfa.edges[s] if on is not None and col[0] in on})
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    labels = [tuple(sorted({accepting[s] for s in states if s in accepting})) for states in order]
    part = [sorted(set(labels)).index(x) for x in labels]
    while True:
        key = {k: i for i, k in enumerate(dict.fromkeys((p, *(part[t] for t in row)) for p, row in zip(part, table, strict=True)))}
        new = [key[(p, *(part[t] for t in row))] for p, row in zip(part, table, strict=True)]
        if len(key) == len(set(part)):
            break
        part = new
    kinds = sorted(set(part), key=lambda p: (bool(labels[part.index(p)]), part.index(p)))
    name = {p: i for i, p in enumerate(kinds)}
    number_of = [256 * i for i in range(len(kinds))]  # one object for each state: lookups stay in the cache
    move, accepts = [0] * (256 * len(kinds)), [()] * len(kinds)
    for s, p in enumerate(part):
        accepts[name[p]] = labels[s]
        for col, t in zip(columns, table[s], strict=True):
            for c in col:
                move[256 * name[p] + c] = number_of[name[part[t]]]
    dead = next((256 * i for i in range(len(kinds)) if not accepts[i] and all(move[256 * i + c] == 256 * i for c in range(256))), -1)
    return Dfa(move, 256 * name[part[0]], 256 * sum(not x for x in accepts), accepts, dead)

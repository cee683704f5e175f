"""A minimal acyclic transducer: sorted terms in, lexicographic ordinals out.

Terms are added in order; as soon as no later term can share a state it is replaced by an
equal one already registered (Daciuk et al., 2000), so the automaton is minimal when the last
term is in, and at no time larger than that and one term. A transition carries the
number of terms that come before those behind it, and a term's ordinal is the sum along its path
(Lucchesi and Kowaltowski, 1993). Bytes are the alphabet, so ordinals follow the
UTF-8 order of the terms.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np


class _State:
    __slots__ = ("final", "next", "number", "terms")

    def __init__(self):
        self.next, self.final, self.number, self.terms = {}, False, -1, 0

    def signature(self):
        return self.final, tuple((b, s.number) for b, s in self.next.items())


class Transducer:
    """``steps[state][byte] = (state, terms before)``; ``final`` the states that end a term."""

    def __init__(self, steps: list[dict[int, tuple[int, int]]], final: list[bool], size: int, root: int):
        self.steps, self.final, self.size, self.root = steps, final, size, root

    @classmethod
    def build(cls, terms: Iterable[bytes]) -> Transducer:
        """From distinct terms in byte order."""
        root, path, last = _State(), [], None
        registered: dict = {}
        states: list[_State] = []

        def settle(depth: int) -> None:
            while len(path) > depth:
                parent, byte, child = path.pop()
                found = registered.get(child.signature())
                if found is None:
                    _number(child)
                    registered[child.signature()] = child
                else:
                    parent.next[byte] = found

        def _number(state: _State) -> None:
            state.number = len(states)
            state.terms = state.final + sum(s.terms for s in state.next.values())
            states.append(state)

        for term in terms:
            if last is not None and term <= last:
                raise ValueError("terms must be distinct and in byte order")
            shared = 0
            for a, (_, b, _) in zip(term, path):
                if a != b:
                    break
                shared += 1
            settle(shared)
            at = path[-1][2] if path else root
            for byte in term[shared:]:
                child = _State()
                at.next[byte] = child
                path.append((at, byte, child))
                at = child
            at.final, last = True, term
        settle(0)
        _number(root)
        steps = []
        for s in states:
            before, row = int(s.final), {}
            for byte, child in s.next.items():
                row[byte] = (child.number, before)
                before += child.terms
            steps.append(row)
        return cls(steps, [s.final for s in states], root.terms, root.number)

    def ordinal(self, term: bytes) -> int:
        """The term's place among the sorted terms, from 0; -1 for others."""
        steps, at, out = self.steps, self.root, 0
        for byte in term:
            step = steps[at].get(byte)
            if step is None:
                return -1
            at, before = step
            out += before
        return out if self.final[at] else -1

    def recount(self, run: bytes, times: np.ndarray) -> np.ndarray:
        """Occurrences by ordinal of a run of terms, a line each, that stand ``times``."""
        out = np.zeros(self.size, np.int64)
        at = np.fromiter(map(self.ordinal, run.split(b"\n")), np.int64)
        known = at >= 0
        np.add.at(out, at[known], times[known])
        return out

    def terms(self) -> Iterator[bytes]:
        """All terms in order."""
        stack = [(self.root, b"")]
        while stack:
            at, prefix = stack.pop()
            if self.final[at]:
                yield prefix
            stack += [(to, prefix + bytes([byte])) for byte, (to, _) in reversed(self.steps[at].items())]

    def dump(self) -> dict[str, bytes]:
        """Flat tables: transitions of all states one after another."""
        flat = [(b, to, before) for row in self.steps for b, (to, before) in row.items()]
        cols = np.array(flat, np.int64).reshape(-1, 3)
        return {
            "width": np.array([len(r) for r in self.steps], "<u2").tobytes(),
            "byte": cols[:, 0].astype("<u1").tobytes(),
            "target": cols[:, 1].astype("<u4").tobytes(),
            "before": cols[:, 2].astype("<u4").tobytes(),
            "final": np.array(self.final, "<u1").tobytes(),
        }

    @classmethod
    def load(cls, width: bytes, byte: bytes, target: bytes, before: bytes, final: bytes) -> Transducer:
        steps, at = [], 0
        flat = list(zip(byte, np.frombuffer(target, "<u4").tolist(), np.frombuffer(before, "<u4").tolist(), strict=True))
        for n in np.frombuffer(width, "<u2").tolist():
            steps.append({b: (to, skip) for b, to, skip in flat[at : at + n]})
            at += n
        ends = [bool(f) for f in final]
        # The root comes last; its terms are those before its last transition and those behind it.
        out = cls(steps, ends, 0, len(steps) - 1)
        out.size = out._count()
        return out

    def _count(self) -> int:
        terms: list[int] = []
        for row, final in zip(self.steps, self.final, strict=True):
            terms.append(int(final) + sum(terms[to] for to, _ in row.values()))
        return terms[self.root]


__all__ = ["Transducer"]

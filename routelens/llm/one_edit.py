"""Pairs of strings one edit apart, by composing a minimal acceptor, a one-edit transducer and the acceptor again."""

from __future__ import annotations

from collections.abc import Iterable, Iterator


class Acceptor:
    """The minimal deterministic acceptor of a finite set of strings; state 0 accepts nothing but the end.

    Strings are added in order; states behind the part that a string shares with the one before are final and are
    merged with an equal state if there is one. No recursion, so long strings do not matter.
    """

    def __init__(self, strings: Iterable[str]):
        self.edges: list[dict[str, int]] = []
        self.ends: list[bool] = []
        self._known: dict[tuple, int] = {}
        path: list[tuple[dict[str, int], list[bool]]] = [({}, [False])]
        letters: list[str] = []
        for string in sorted(set(strings)):
            shared = 0
            for old, new in zip(letters, string):  # the shorter one decides
                if old != new:
                    break
                shared += 1
            self._close(path, letters, shared)
            for letter in string[shared:]:
                letters.append(letter)
                path.append(({}, [False]))
            path[-1][1][0] = True
        self._close(path, letters, 0)
        self.start = self._state(*path[0])

    def _close(self, path: list, letters: list[str], keep: int) -> None:
        while len(letters) > keep:
            state = self._state(*path.pop())
            path[-1][0][letters.pop()] = state

    def _state(self, edges: dict[str, int], end: list[bool]) -> int:
        key = (end[0], *edges.items())
        state = self._known.get(key)
        if state is None:
            state = self._known[key] = len(self.edges)
            self.edges.append(edges)
            self.ends.append(end[0])
        return state


def one_edit_pairs(acceptor: Acceptor, end_insertions: bool = True) -> Iterator[tuple[str, str]]:
    """Every pair of accepted strings that differ by one replaced or inserted code point, once.

    The composed machine reads equal code points until the edit (both sides are then in one state), makes the edit, and
    reads equal code points until both sides accept. A code point inserted into a run of its like counts as the
    run's last, so the pair is accepted on one path only. Without ``end_insertions`` none stands at the very end.
    The second string of a pair is the longer one, or of two equally long ones the greater.
    """
    edges = acceptor.edges
    empty: set[tuple[int, int]] = set()
    path: list[str] = []
    stack: list[tuple[int, int, str]] = [(acceptor.start, 0, "")]
    while stack:
        state, depth, letter = stack.pop()
        if depth:
            del path[depth - 1 :]
            path.append(letter)
        out = sorted(edges[state].items())
        for i, (one, after) in enumerate(out):
            for tail in _common_tails(acceptor, state, after, one, empty):  # ``one`` inserted
                if tail or end_insertions:
                    head = "".join(path)
                    yield head + tail, head + one + tail
            for other, beyond in out[i + 1 :]:
                for tail in _common_tails(acceptor, after, beyond, None, empty):
                    head = "".join(path)
                    yield head + one + tail, head + other + tail
        stack += [(after, depth + 1, one) for one, after in out]


def _common_tails(acceptor: Acceptor, left: int, right: int, not_first: str | None, empty: set) -> Iterator[str]:
    """Strings accepted from both states, but for those that begin with ``not_first``. Pairs of states without any are remembered."""
    edges, ends = acceptor.edges, acceptor.ends
    tail: list[str] = []
    found = 0
    stack: list[tuple] = [(left, right, 0, "", -1)]
    while stack:
        one, two, depth, letter, before = stack.pop()
        if before >= 0:  # everything behind this pair has been read
            if before == found:
                empty.add((one, two))
            continue
        if (one, two) in empty:
            continue
        if depth:
            del tail[depth - 1 :]
            tail.append(letter)
        if depth or not_first is None:
            stack.append((one, two, depth, letter, found))
        if ends[one] and ends[two]:
            found += 1
            yield "".join(tail)
        few, many = (edges[one], edges[two]) if len(edges[one]) <= len(edges[two]) else (edges[two], edges[one])
        for step in few:
            if step in many and (depth or step != not_first):
                stack.append((edges[one][step], edges[two][step], depth + 1, step, -1))

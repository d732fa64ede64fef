"""A suffix automaton over words for several reference texts."""

from __future__ import annotations

from collections.abc import Iterable


class SuffixAutomaton:
    """Knows every word sequence of its references and, for sequences of
    ``window`` words, the smallest reference id that has them.

    References are added in ascending id order; ``close`` ends the building.
    """

    def __init__(self, window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.first: list[int] = [0]
        self.floor: list[int] = []

    def _state(self, length: int, edges: dict[int, int], link: int, doc: int) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        self.first.append(doc)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        """Split from ``q`` the sequences that end after ``p`` by ``c``."""
        nxt, link = self.next, self.link
        made = self._state(self.length[p] + 1, dict(nxt[q]), link[q], self.first[q])
        while p >= 0 and nxt[p].get(c) == q:
            nxt[p][c] = made
            p = link[p]
        link[q] = made
        return made

    def add(self, words: Iterable[bytes], doc: int) -> None:
        nxt, link, length, codes = self.next, self.link, self.length, self.codes
        last = 0
        for word in words:
            c = codes.setdefault(word, len(codes))
            q = nxt[last].get(c)
            if q is not None:  # an earlier reference has it
                last = q if length[last] + 1 == length[q] else self._clone(last, q, c)
                continue
            new = self._state(length[last] + 1, {}, 0, doc)
            p = last
            while p >= 0 and c not in nxt[p]:
                nxt[p][c] = new
                p = link[p]
            if p >= 0:
                q = nxt[p][c]
                link[new] = q if length[p] + 1 == length[q] else self._clone(p, q, c)
            last = new

    def close(self) -> None:
        """Give each state the smallest id of all places it ends at, and the
        ancestor that stands for its last ``window`` words."""
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        first, link = self.first, self.link
        first[0] = min(first)
        for v in reversed(order):
            if link[v] and first[v] < first[link[v]]:
                first[link[v]] = first[v]
        self.floor = [0] * len(link)
        for v in order:
            up = link[v]
            self.floor[v] = self.floor[up] if self.length[up] >= self.window else v

    def covered(self, words: list[bytes], doc: int) -> list[tuple[int, int]]:
        """Maximal spans ``[start, end)`` of ``words`` covered by windows that a
        reference with a smaller id than ``doc`` has.

        Streams the words with the matching statistic: the length of the
        longest suffix read so far that any reference has.
        """
        nxt, link, length, first, floor = self.next, self.link, self.length, self.first, self.floor
        window, codes = self.window, self.codes
        spans: list[list[int]] = []
        state = match = 0
        for at, word in enumerate(words):
            c = codes.get(word)
            if c is None:
                state = match = 0
                continue
            while state and c not in nxt[state]:
                state = link[state]
                match = length[state]
            to = nxt[state].get(c)
            if to is None:
                match = 0
                continue
            state = to
            match += 1
            if match >= window and first[floor[state]] < doc:
                start = at + 1 - window
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = at + 1
                else:
                    spans.append([start, at + 1])
        return [(a, b) for a, b in spans]

"""A suffix automaton over sequences of numbers, with weighted counts of occurrences."""

from __future__ import annotations


class SuffixAutomaton:
    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def add(self, sequence: list[int], weight: int) -> None:
        """Add a sequence; every end of a prefix counts ``weight`` times."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for x in sequence:
            to = nxt[last].get(x)
            if to is not None and length[to] == length[last] + 1:
                last = to  # known from an earlier sequence
                count[last] += weight
                continue
            if to is not None:
                last = self._clone(last, x, to)
                count[last] += weight
                continue
            new = len(nxt)
            nxt.append({})
            link.append(0)
            length.append(length[last] + 1)
            count.append(weight)
            p = last
            while p >= 0 and x not in nxt[p]:
                nxt[p][x] = new
                p = link[p]
            if p >= 0:
                to = nxt[p][x]
                link[new] = to if length[to] == length[p] + 1 else self._clone(p, x, to)
            last = new

    def _clone(self, p: int, x: int, to: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        twin = len(nxt)
        nxt.append(dict(nxt[to]))
        link.append(link[to])
        length.append(length[p] + 1)
        self.count.append(0)
        link[to] = twin
        while p >= 0 and nxt[p].get(x) == to:
            nxt[p][x] = twin
            p = link[p]
        return twin

    def settle(self) -> None:
        """Hand the counts on along the suffix links, from the longest state to the shortest."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def occurrences(self, sequence: list[int], width: int) -> list[int]:
        """Matching statistics of a stream, held at ``width``: how often each of its windows of ``width`` occurs."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        out = []
        state = size = 0
        for i, x in enumerate(sequence):
            while state and x not in nxt[state]:
                state = link[state]
                size = length[state]
            if x in nxt[state]:
                state = nxt[state][x]
                size += 1
            else:
                size = 0
            while size >= width and length[link[state]] >= width:
                state = link[state]
                size = length[state]
            if i >= width - 1:
                out.append(count[state] if size >= width else 0)
        return out

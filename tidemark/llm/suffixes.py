"""Suffix arrays of many short byte strings, by Larsson-Sadakane refinement and Kasai's common prefixes."""

from __future__ import annotations

import numpy as np

_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


class SuffixArray:
    """Suffixes of all strings of a shard in order, each with the bytes it shares with the one before.

    Suffixes end with their string; equal ones stand in order of place.
    """

    def __init__(self, strings: list[bytes]):
        size = np.array([len(s) for s in strings], np.int64)
        self.first = np.concatenate([[0], np.cumsum(size)])
        data = np.frombuffer(b"".join(strings) + bytes(8), np.uint8)
        n = len(data) - 8
        self.string = np.repeat(np.arange(len(strings)), size)
        self.left = self.first[1:][self.string] - np.arange(n)  # bytes up to the string's end
        self.eights = np.ascontiguousarray(np.ndarray(n, "<u8", data.data, 0, (1,)))
        self._sort()
        self._common()

    def _sort(self) -> None:
        n = len(self.left)
        short = np.minimum(self.left, 8)
        # Eight bytes compare as one big-endian number; a suffix that ends among them comes first.
        head = (self.eights & _MASKS[short]).byteswap()
        order = np.lexsort((short, head))
        new = np.ones(n, bool)
        new[1:] = (head[order[1:]] != head[order[:-1]]) | (short[order[1:]] != short[order[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1  # where the group starts, from 1
        depth = 8
        while depth < self.left.max(initial=0):
            # Only groups of several suffixes are refined, by the rank of what follows.
            end = np.append(new[1:], True)
            places = np.flatnonzero(~(new & end))
            if not len(places):
                break
            at = order[places]
            follow = np.where(self.left[at] > depth, rank[np.minimum(at + depth, n - 1)], 0)
            again = np.lexsort((follow, rank[at]))
            at, follow, group = at[again], follow[again], rank[at][again]
            order[places] = at
            fresh = np.ones(len(at), bool)
            fresh[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
            new[places] = fresh
            rank[at] = places[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] + 1
            depth *= 2
        self.order = order

    def _common(self) -> None:
        """Kasai's rule, all strings side by side: from one suffix to the next a prefix loses one byte at most."""
        n = len(self.left)
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        before = np.where(place > 0, self.order[np.maximum(place - 1, 0)], -1)
        common = np.zeros(n, np.int64)
        size = np.diff(self.first)
        strings = np.argsort(-size, kind="stable")
        known = np.zeros(len(size), np.int64)
        for offset in range(int(size.max(initial=0))):
            live = strings[: np.searchsorted(-size[strings], -offset)]
            i = self.first[live] + offset
            j = before[i]
            l = np.where(j >= 0, np.maximum(known[live] - 1, 0), 0)
            most = np.where(j >= 0, np.minimum(self.left[i], self.left[np.maximum(j, 0)]), 0)
            l = np.minimum(l, most)
            go = np.flatnonzero(l < most)
            while len(go):
                differ = self.eights[i[go] + l[go]] ^ self.eights[j[go] + l[go]]
                # Bytes that agree before the lowest one that differs.
                low = differ & (~differ + np.uint64(1))
                equal = np.where(differ == 0, 8, np.searchsorted(_MASKS[1:], low, "left"))
                l[go] = np.minimum(l[go] + equal, most[go])
                go = go[(equal == 8) & (l[go] < most[go])]
            common[i] = l
            known[live] = l
        self.common = common[self.order]  # with the suffix before

    def groups(self, depth: int) -> np.ndarray:
        """For each suffix, by place, the number of its group of suffixes that agree in ``depth`` bytes."""
        group = np.empty(len(self.order), np.int64)
        group[self.order] = np.cumsum(self.common < depth)
        return group

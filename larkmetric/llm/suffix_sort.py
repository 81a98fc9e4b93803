"""Deep-shallow sorting of suffixes: multikey quicksort, then blind tries.

Suffixes come as rows of a byte matrix. Multikey quicksort parts each group of
suffixes that are equal so far in three, by eight bytes taken as one character:
below, at and above that of a pivot. Those at it go on eight bytes deeper. All
groups take their steps together. Groups still equal at the shallow depth share
a long prefix; a blind trie, which holds only the places where suffixes part,
puts each in order with one comparison.
"""

from __future__ import annotations

import numpy as np

from larkmetric.llm.arrays import ragged

SHALLOW = 32


def _words(rows: np.ndarray, which: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes of each row from its depth on, as one number; zeros beyond the end."""
    part = np.zeros((len(which), 8), dtype=np.uint8)
    for k in range(8):
        inside = at + k < rows.shape[1]
        part[inside, k] = rows[which[inside], at[inside] + k]
    return part.view(">u8").ravel().astype(np.uint64)


def _common(a: bytes, b: bytes, low: int) -> int:
    """Length of the common prefix, of which ``low`` bytes are known."""
    high = min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        mid = (low + high + 1) // 2
        if a[:mid] == b[:mid]:
            low = mid
        else:
            high = mid - 1
    return low


class BlindTrie:
    """Suffixes in order; inner nodes hold a depth and a child for each byte there (-1: the end)."""

    def __init__(self) -> None:
        self.root: list | None = None

    def insert(self, suffix: bytes, name: int) -> None:
        leaf = [None, suffix, [name]]
        if self.root is None:
            self.root = leaf
            return
        path, node = [], self.root
        while node[0] is not None:
            path.append(node)
            depth, children = node[0], node[1]
            node = children.get(suffix[depth] if depth < len(suffix) else -1) or next(iter(children.values()))
        other = node[1]
        depth = _common(suffix, other, 0)
        if depth == len(suffix) == len(other):
            node[2].append(name)
            return
        path.append(node)
        i = next(i for i, x in enumerate(path) if x[0] is None or x[0] >= depth)
        byte = suffix[depth] if depth < len(suffix) else -1
        if path[i][0] == depth:
            path[i][1][byte] = leaf
            return
        inner = [depth, {byte: leaf, (other[depth] if depth < len(other) else -1): path[i]}]
        if i:
            above = path[i - 1]
            above[1][other[above[0]] if above[0] < len(other) else -1] = inner
        else:
            self.root = inner

    def ordered(self) -> list[int]:
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] is None:
                out += node[2]
            else:
                stack += [child for _, child in sorted(node[1].items(), reverse=True)]
        return out


def sort(group: np.ndarray, rows: np.ndarray, lengths: np.ndarray, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of suffixes within sorted groups, and of each the prefix it shares with the one before (-1: none before).

    ``rows`` are padded with zeros beyond ``lengths``.
    """
    n = len(rows)
    order = np.argsort(group, kind="stable")
    run = group[order]
    first = np.ones(n, dtype=bool)
    first[1:] = run[1:] != run[:-1]
    depth = np.zeros(n, dtype=np.int64)  # of each place: what its group is known to share
    while True:
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, n))
        going = (sizes > 1) & (depth[starts] < min(shallow, rows.shape[1]))
        if not going.any():
            break
        starts, sizes = starts[going], sizes[going]
        places = ragged(starts, sizes)
        group_of = np.repeat(np.arange(len(starts)), sizes)
        word = _words(rows, order[places], depth[places])
        pivot = word[(np.cumsum(sizes) - sizes) + sizes // 2][group_of]
        side = (word > pivot).astype(np.int8) - (word < pivot)
        by = np.lexsort((side, group_of))
        order[places] = order[places][by]
        side = side[by]
        first[places[1:]] |= (side[1:] != side[:-1]) & (group_of[1:] == group_of[:-1])
        depth[places[side == 0]] += 8
    starts = np.flatnonzero(first)
    ends = np.append(starts[1:], n)
    for i, j in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        trie = BlindTrie()
        for k in order[i:j].tolist():
            trie.insert(rows[k, : lengths[k]].tobytes(), k)
        order[i:j] = trie.ordered()
    shared = np.full(n, -1, dtype=np.int64)
    for part in np.array_split(np.arange(1, n), max(1, n // 50_000)):
        a, b = order[part - 1], order[part]
        apart = rows[a] != rows[b]
        depth = np.where(apart.any(axis=1), apart.argmax(axis=1), rows.shape[1])
        depth = np.minimum(depth, np.minimum(lengths[a], lengths[b]))
        shared[part] = np.where(group[a] == group[b], depth, -1)
    return order, shared

"""Sorting of byte strings by the deep-shallow method: multikey quicksort first, blind tries for what stays together."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

SHALLOW = 32  # bytes looked at by the quicksort, a multiple of 8
END = -1  # branch of a string that ends at a node


def _same_bytes(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b))
    differing = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differing.bit_length() + 7) // 8


class BlindTrie:
    """A compacted trie that keeps only depths and branching bytes.

    Inner nodes are ``[depth, {byte: child}]``, leaves lists of equal strings.
    A string goes down by branching bytes alone, is compared once with the
    leaf that it meets, and is then hung in at the depth of the difference.
    """

    def __init__(self, strings: Sequence[bytes], first: int):
        self.strings = strings
        self.root: list = [first]

    @staticmethod
    def _is_leaf(node: list) -> bool:
        return len(node) < 2 or not isinstance(node[1], dict)

    def _branch(self, i: int, depth: int) -> int:
        s = self.strings[i]
        return s[depth] if depth < len(s) else END

    def add(self, i: int) -> None:
        node = self.root
        while not self._is_leaf(node):
            node = node[1].get(self._branch(i, node[0])) or next(iter(node[1].values()))
        met = node[0]
        depth = _same_bytes(self.strings[i], self.strings[met])
        if depth == len(self.strings[i]) == len(self.strings[met]):
            node.append(i)
            return
        above, node = None, self.root
        while not self._is_leaf(node) and node[0] < depth:
            above, node = node, node[1][self._branch(met, node[0])]
        if not self._is_leaf(node) and node[0] == depth:
            node[1][self._branch(i, depth)] = [i]
            return
        inner = [depth, {self._branch(i, depth): [i], self._branch(met, depth): node}]
        if above is None:
            self.root = inner
        else:
            above[1][self._branch(met, above[0])] = inner

    def in_order(self) -> tuple[list[int], list[int]]:
        """Strings in order, and how many bytes each shares with the one before it (the first: 0)."""
        order, shared, open_nodes = [], [], [(self.root, 0)]
        while open_nodes:
            node, common = open_nodes.pop()
            if self._is_leaf(node):
                shared += [common, *[len(self.strings[node[0]])] * (len(node) - 1)]
                order += node
            else:
                depth, children = node
                ordered = [children[b] for b in sorted(children)]
                open_nodes += [(child, depth) for child in reversed(ordered[1:])]
                open_nodes.append((ordered[0], common))
        return order, shared


def deep_shallow(strings: Sequence[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings inside their groups, and the bytes shared with the one before (-1 at the start of a group).

    All groups are split at once: a step of the quicksort orders whatever is
    still together by its next eight bytes. Strings that agree in the first
    ``SHALLOW`` bytes are ordered in a blind trie of their own.
    """
    n = len(strings)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    heads = np.frombuffer(b"".join(s[:SHALLOW].ljust(SHALLOW, b"\0") for s in strings), np.uint8).reshape(n, SHALLOW)
    words = heads.view(">u8").astype(np.uint64)
    length = np.fromiter(map(len, strings), np.int64, n)
    order = np.argsort(group, kind="stable")
    starts = np.r_[True, np.diff(group[order]) != 0]
    group_starts = starts.copy()
    for word in range(words.shape[1]):
        ends = np.r_[starts[1:], True]
        together = np.flatnonzero(~(starts & ends))
        if not len(together):
            break
        part = np.cumsum(starts)[together]
        step = np.lexsort((words[order[together], word], part))
        order[together] = order[together][step]
        value = words[order[together], word]
        differs = np.r_[True, (value[1:] != value[:-1]) | (part[1:] != part[:-1])]
        starts[together] |= differs
    shared = np.zeros(n, np.int64)
    begin = np.flatnonzero(starts)
    for at, to in zip(begin.tolist(), np.r_[begin[1:], n].tolist(), strict=True):
        if to - at > 1:
            members = order[at:to].tolist()
            trie = BlindTrie(strings, members[0])
            for i in members[1:]:
                trie.add(i)
            order[at:to], shared[at:to] = trie.in_order()
    inner = begin[1:]
    differing = heads[order[inner]] != heads[order[inner - 1]]
    first = np.where(differing.any(axis=1), differing.argmax(axis=1), SHALLOW)
    shared[inner] = np.minimum(first, np.minimum(length[order[inner]], length[order[inner - 1]]))
    shared[group_starts] = -1
    return order, shared

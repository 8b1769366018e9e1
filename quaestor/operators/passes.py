"""The removing pass over blocks of sparse vectors, inside one task.

A block holds the vectors of consecutive nodes of a scope. Terms are dealt
out to classes, and a vector's norms in them are its sketch: the
product of two sketches is never below that of the vectors (Cauchy-Schwarz in
each class). So one product of two tables of sketches bounds all pairs of two
blocks, and only pairs that can reach the threshold are multiplied out. Two
long vectors fill most classes, so such pairs take a sketch of more of them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa

ROWS = 1024         # left rows that act together
CELLS = 1 << 21     # cells of one table of bounds
NORMS = 128         # classes of terms
WIDE = 512          # of pairs of long vectors
LONG = 128          # entries that a short vector has at most
DENSE = 5_000_000   # numbers in the dense copy of the left rows
GATHERED = 1 << 17  # entries that are worked on together
SLACK = 1e-4        # over the rounding errors of a bound

FOUND = pa.schema([("scope", pa.string()), ("kind", pa.int32()), ("i", pa.int64()), ("j", pa.int64()), ("similarity", pa.float64())])
FOUND_DDL = "scope string, kind int, i bigint, j bigint, similarity double"
ROOT, REMOVED, FALL = 0, 1, 2


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the given spans, one span after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def _content(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and the length of each value."""
    values = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.binary())
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    ends = np.frombuffer(values.buffers()[1], np.int32)[values.offset:values.offset + len(values) + 1].astype(np.int64)
    return np.frombuffer(values.buffers()[2], np.uint8)[ends[0]:ends[-1]], np.diff(ends)


@dataclass
class Block:
    """Unit vectors in the order of their nodes."""
    node: np.ndarray
    rank: np.ndarray
    start: np.ndarray   # first entry of each vector
    size: np.ndarray
    term: np.ndarray
    w: np.ndarray

    @classmethod
    def made(cls, node: np.ndarray, rank: np.ndarray, size: np.ndarray, term: np.ndarray, x: np.ndarray) -> Block:
        """From weights of any length; every vector has entries."""
        start = np.cumsum(size) - size
        w = x / np.repeat(np.sqrt(np.add.reduceat(x * x, start)), size) if len(node) else x
        return cls(node, rank, start, size, term, w)

    @classmethod
    def of(cls, table: pa.Table, threshold: float | None = None) -> Block:
        """From ``node, rank, terms, xs``."""
        table = table.combine_chunks().sort_by("node")
        terms, xs = (table[c].combine_chunks() for c in ("terms", "xs"))
        size = terms.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        return cls.made(table["node"].to_numpy(), table["rank"].to_numpy(), size,
                        terms.flatten().to_numpy(zero_copy_only=False), xs.flatten().to_numpy(zero_copy_only=False))

    @classmethod
    def packed(cls, table: pa.Table, idf: np.ndarray) -> Block:
        """From ``node, rank, terms, tfs``: places of terms and their counts as bytes."""
        table = table.combine_chunks().sort_by("node")
        tfs, ends = _content(table["tfs"])
        size, tfs = ends // 4, tfs.view(np.uint32)
        terms = _content(table["terms"])[0]
        terms = terms.view(np.uint16 if len(terms) == 2 * len(tfs) else np.uint32).astype(np.int32)
        return cls.made(table["node"].to_numpy(), table["rank"].to_numpy(), size, terms, tfs * idf[terms] if len(terms) else np.zeros(0))

    def __len__(self) -> int:
        return len(self.node)

    def take(self, rows: np.ndarray) -> Block:
        size, at = self.size[rows], _spans(self.start[rows], self.size[rows])
        return Block(self.node[rows], self.rank[rows], np.cumsum(size) - size, size, self.term[at], self.w[at])

    @cached_property
    def width(self) -> int:
        return int(self.term.max(initial=0)) + 1

    def norms(self, classes: int) -> np.ndarray:
        """Norms of each vector in so many classes of terms."""
        out = np.empty((len(self), classes), np.float32)
        step = max(1, GATHERED // classes)
        for r in range(0, len(self), step):
            size = self.size[r:r + step]
            at = slice(self.start[r], self.start[r] + int(size.sum()))
            cell = np.repeat(np.arange(len(size)), size) * classes + self.term[at] % classes
            out[r:r + step] = np.sqrt(np.bincount(cell, self.w[at] * self.w[at], len(size) * classes)).reshape(-1, classes)
        return out

    @cached_property
    def narrow(self) -> np.ndarray:
        return self.norms(NORMS)

    @cached_property
    def wide(self) -> tuple[np.ndarray, np.ndarray]:
        """Sketches of the long vectors, and the place of each row among them."""
        long = self.size > LONG
        return self.take(np.flatnonzero(long)).norms(WIDE), np.cumsum(long) - 1

    def sketches(self, rows: np.ndarray, wide: bool) -> np.ndarray:
        return self.wide[0][self.wide[1][rows]] if wide else self.narrow[rows]

    def by_length(self, rows: np.ndarray) -> list[tuple[bool, np.ndarray]]:
        """Places of the short and of the long vectors among the rows."""
        long = self.size[rows] > LONG
        return [(kind, at) for kind, at in ((False, np.flatnonzero(~long)), (True, np.flatnonzero(long))) if len(at)]


def _products(dense: np.ndarray, i: np.ndarray, right: Block, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows."""
    out, sizes = np.zeros(len(i)), right.size[j]
    done, upto = 0, np.cumsum(sizes)
    while done < len(i):
        end = max(done + 1, int(np.searchsorted(upto, GATHERED + (upto[done - 1] if done else 0), "right")))
        own = sizes[done:end]
        at = _spans(right.start[j[done:end]], own)
        x = dense.ravel().take(np.repeat(i[done:end] * dense.shape[1], own) + right.term.take(at))
        out[done:end] = np.add.reduceat(x * right.w.take(at), np.cumsum(own) - own)
        done = end
    return out


def similar(left: Block, li: np.ndarray, right: Block, ri: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in ``li`` and ``ri`` and similarity of all pairs of these rows above the threshold whose left node comes first, in order."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    width = max(left.width, right.width)
    rows = max(1, min(ROWS, DENSE // width))
    groups = right.by_length(ri)
    for r in range(0, len(li), rows):
        chunk, dense = li[r:r + rows], None
        for long, own in left.by_length(chunk):
            columns = max(1, CELLS // len(own))
            for both, every in ((long and other, at) for other, at in groups):
                sketches = left.sketches(chunk[own], both)
                for c in range(0, len(every), columns):
                    others = every[c:c + columns]
                    if right.node[ri[others[-1]]] <= left.node[chunk[own[0]]]:
                        continue
                    hits = np.flatnonzero((sketches @ right.sketches(ri[others], both).T).ravel() > threshold - SLACK)
                    i, j = np.divmod(hits, len(others))
                    i, j = own[i], others[j]
                    ahead = left.node[chunk[i]] < right.node[ri[j]]
                    i, j = i[ahead], j[ahead]
                    if not len(i):
                        continue
                    if dense is None:
                        at = _spans(left.start[chunk], left.size[chunk])
                        dense = np.zeros((len(chunk), width))
                        dense[np.repeat(np.arange(len(chunk)), left.size[chunk]), left.term[at]] = left.w[at]
                    s = _products(dense, i, right, ri[j])
                    kept = s > threshold
                    found.append((i[kept] + r, j[kept], s[kept]))
    i, j, s = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((j, i))
    return i[order], j[order], s[order]


class _Rows:
    """Findings of a task: roots, first removers, and falls."""

    def __init__(self):
        self.parts: list[tuple] = []

    def add(self, kind: int, i: np.ndarray, j: np.ndarray, s: np.ndarray | None = None) -> None:
        if len(j):
            self.parts.append((np.full(len(j), kind, np.int32), np.broadcast_to(i, len(j)), j, np.zeros(len(j)) if s is None else s))

    def table(self, scope: str) -> pa.Table:
        if not self.parts:
            return FOUND.empty_table()
        kind, i, j, s = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        return pa.table([pa.array([scope] * len(j), pa.string()), kind, i.astype(np.int64), j.astype(np.int64), s], schema=FOUND)


def _act_in_turn(block: Block, rows: np.ndarray, threshold: float, alive: np.ndarray, out: _Rows) -> None:
    """Let consecutive rows act on each other; those that are gone when their turn comes do nothing."""
    i, j, s = similar(block, rows, block, rows, threshold)
    for own in np.split(np.arange(len(i)), np.flatnonzero(np.diff(i)) + 1) if len(i) else ():
        row = rows[i[own[0]]]
        if not alive[row]:
            continue
        there = own[alive[rows[j[own]]]]
        target = rows[j[there]]
        removes = block.rank[row] >= block.rank[target]
        out.add(REMOVED, block.node[row], block.node[target[removes]], s[there[removes]])
        out.add(FALL, block.node[row], block.node[target[~removes]], s[there[~removes]])
        alive[target[removes]] = False


def _act(roots: Block, acting: np.ndarray, block: Block, at: np.ndarray, threshold: float, alive: np.ndarray, out: _Rows) -> None:
    """Let roots act in their order on the rows ``at`` behind them, all of which are still there."""
    i, j, s = similar(roots, acting, block, at, threshold)
    removes = roots.rank[acting[i]] >= block.rank[at[j]]
    first = np.full(len(at), len(acting))
    first[j[removes][::-1]] = i[removes][::-1]  # of the removers of a row the earliest is written last
    for kind, kept in ((REMOVED, removes & (i == first[j])), (FALL, ~removes & (i < first[j]))):
        out.add(kind, roots.node[acting[i[kept]]], block.node[at[j[kept]]], s[kept])
    alive[at[first < len(acting)]] = False


def decide(block: Block, threshold: float, out: _Rows, alive: np.ndarray | None = None) -> None:
    """One pass over a block in order. Nothing of the block that is ``alive`` is removed or decided from outside any more."""
    alive = np.ones(len(block), bool) if alive is None else alive
    for at in range(0, len(block), ROWS):
        _act_in_turn(block, np.flatnonzero(alive[at:at + ROWS]) + at, threshold, alive, out)
        roots = np.flatnonzero(alive[at:at + ROWS]) + at
        out.add(ROOT, block.node[roots], block.node[roots])
        _act(block, roots, block, np.flatnonzero(alive[at + ROWS:]) + at + ROWS, threshold, alive, out)


def strike(roots: Block, block: Block, threshold: float, out: _Rows) -> np.ndarray:
    """What roots ahead of a block do to it; the rows that are left."""
    alive = np.ones(len(block), bool)
    for at in range(0, len(roots), ROWS):
        _act(roots, np.arange(at, min(at + ROWS, len(roots))), block, np.flatnonzero(alive), threshold, alive, out)
    return alive

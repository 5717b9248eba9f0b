"""Ordered trees as balanced parentheses, with a tree of the least excess per block for jumps to the closing one."""

from __future__ import annotations

import numpy as np

BLOCK = 256


class Parentheses:
    """``bits``: 1 opens a node, 0 closes it, in depth-first order. Nodes are numbered in the order they open."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits.astype(bool)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        self.open_at = np.flatnonzero(self.bits)                       # select of the opening ones
        self.opened = np.cumsum(self.bits)                             # rank: nodes opened up to a place
        leaf = np.zeros(len(bits), np.int64)
        leaf[:-1] = self.bits[:-1] & ~self.bits[1:]
        self.leaves = np.cumsum(leaf)                                  # rank: pairs () that begin up to a place
        n = max(1, -(-len(bits) // BLOCK))
        least = np.minimum.reduceat(self.excess, np.arange(0, len(bits), BLOCK)) if len(bits) else np.zeros(1, np.int64)
        self.base = 1 << (n - 1).bit_length()
        self.least = np.full(2 * self.base, np.iinfo(np.int64).max)
        self.least[self.base:self.base + n] = least
        for k in range(self.base - 1, 0, -1):
            self.least[k] = min(self.least[2 * k], self.least[2 * k + 1])

    def find_close(self, at: int) -> int:
        """The place that closes the node opened at ``at``: the first after it with an excess one lower."""
        wanted = self.excess[at] - 1
        end = (at // BLOCK + 1) * BLOCK
        near = np.flatnonzero(self.excess[at + 1:end] == wanted)
        if len(near):
            return at + 1 + int(near[0])
        k = self.base + at // BLOCK
        while k & 1 or self.least[k + 1] > wanted:                      # up, until a block to the right goes low enough
            k >>= 1
        k += 1
        while k < self.base:                                            # down to the first such block
            k = 2 * k if self.least[2 * k] <= wanted else 2 * k + 1
        begin = (k - self.base) * BLOCK
        return begin + int(np.argmax(self.excess[begin:begin + BLOCK] == wanted))

    def subtrees(self) -> np.ndarray:
        """For every node the place that closes it."""
        return np.fromiter(map(self.find_close, self.open_at.tolist()), np.int64, len(self.open_at))

    def leaf_counts(self, closes: np.ndarray) -> np.ndarray:
        before = np.where(self.open_at > 0, self.leaves[self.open_at - 1], 0)
        return self.leaves[closes] - before

    def sums(self, closes: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Sums of the nodes' values over their subtrees, from one cumulative array."""
        upto = np.concatenate([[0], np.cumsum(values)])
        nodes = np.arange(len(self.open_at))
        return upto[self.opened[closes]] - upto[nodes]

    def children(self, closes: np.ndarray, node: int) -> list[int]:
        """The nodes right below one, each found behind the closing of the one before."""
        out, at = [], int(self.open_at[node]) + 1
        while self.bits[at]:
            child = int(self.opened[at]) - 1
            out.append(child)
            at = int(closes[child]) + 1
        return out

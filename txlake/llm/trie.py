"""Double-array tries over word numbers, built and walked with numpy.

A word number is two digits, high and low, so a node has at most ``DIGITS``
children. ``base[s] + digit`` is the place of a child of ``s`` and ``check`` there
holds ``s``; a walk of many positions is two gathers per digit.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

DIGITS = 1024
#: Words that one trie can number.
MOST_WORDS = DIGITS * DIGITS
ROOT = 0
#: Free places are sought in so many windows of this many places, and a window is left for good when less
#: than one in ``FULL`` of its places is free; after them a node's children go behind all others.
WINDOW, WINDOWS, FULL = 2048, 64, 4
#: Places tried times children, in one go.
MOST_TRIED = 1 << 15


@dataclass
class Trie:
    """``base`` and ``check`` by place; ``ends[i]`` is the place where the i-th phrase ends."""

    base: np.ndarray
    check: np.ndarray
    ends: np.ndarray

    def step(self, states: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Go on by one word number from each state: which go on, and their new states."""
        high = self.base[states] + (words >> 10)
        ok = np.flatnonzero(self.check[high] == states)
        high = high[ok]
        low = self.base[high] + (words[ok] & (DIGITS - 1))
        on = self.check[low] == high
        return ok[on], low[on]


def build(phrases: np.ndarray) -> Trie:
    """A trie of phrases, given as rows of word numbers that are padded with -1 behind."""
    digits = np.full((len(phrases), 2 * phrases.shape[1]), -1, np.int64)
    digits[:, 0::2] = np.where(phrases >= 0, phrases >> 10, -1)
    digits[:, 1::2] = np.where(phrases >= 0, phrases & (DIGITS - 1), -1)
    parents, labels = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]  # of the root, unused
    at = np.zeros(len(phrases), np.int64)
    nodes = 1
    for column in digits.T:
        on = np.flatnonzero(column >= 0)
        made, which = np.unique(at[on] * DIGITS + column[on], return_inverse=True)
        parents.append(made // DIGITS)
        labels.append(made % DIGITS)
        at[on] = nodes + which
        nodes += len(made)
    parent, label = np.concatenate(parents), np.concatenate(labels)
    base, size = _placed(parent[1:], label[1:], nodes)
    place = np.concatenate([[ROOT], base[parent[1:]] + label[1:]])
    by_place, check = np.zeros(size + DIGITS, np.int32), np.full(size + DIGITS, -1, np.int32)
    by_place[place] = base
    check[place[1:]] = place[parent[1:]]
    return Trie(by_place, check, place[at].astype(np.int32))


def _placed(parent: np.ndarray, label: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
    """A base for every node, so that no two children share a place; nodes with many children first."""
    base = np.zeros(nodes, np.int64)
    order = np.lexsort((label, parent))
    parent, label = parent[order], label[order]
    owners, begins, many = np.unique(parent, return_index=True, return_counts=True)
    used = np.zeros(4 * DIGITS + 2 * len(label), bool)
    used[:DIGITS] = True  # the root's place, and no base below 0
    front = end = DIGITS
    for k in np.argsort(-many, kind="stable"):
        if many[k] == 1:
            break
        children = label[begins[k] : begins[k] + many[k]]
        at, start = front, -1
        for _ in range(WINDOWS):
            free = at + np.flatnonzero(~used[at : min(at + WINDOW, end)])
            full = len(free) < WINDOW // FULL
            free = free[: max(16, MOST_TRIED // many[k])]
            fits = ~used[free[:, None] - children[0] + children].any(axis=1)
            if fits.any():
                start = int(free[fits.argmax()] - children[0])
                break
            if at == front and full:
                front = min(front + WINDOW, end)
            at += WINDOW
        if start < 0:
            start = end - int(children[0])
        base[owners[k]] = start
        used[start + children] = True
        end = max(end, start + int(children[-1]) + 1)
        if end + 2 * DIGITS > len(used):
            used = np.concatenate([used, np.zeros(len(used), bool)])
    alone = many == 1
    lonely = label[begins[alone]]
    free = np.flatnonzero(~used)
    if len(free) < len(lonely):
        free = np.concatenate([free, len(used) + np.arange(len(lonely) - len(free))])
    base[owners[alone]] = free[: len(lonely)] - lonely
    return base, max(int(free[len(lonely) - 1]) + 1 if len(lonely) else 0, end)

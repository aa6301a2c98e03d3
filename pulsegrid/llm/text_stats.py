"""Exact per-text word statistics used by the quality operators (small per-text helpers)."""

from __future__ import annotations

import numpy as np

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def word_ids(words: list[bytes]) -> np.ndarray:
    """A small integer for each word; equal words get equal integers."""
    seen: dict[bytes, int] = {}
    return np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))


def repeated_in_windows(ids: np.ndarray, width: int = 8) -> int:
    """Words inside ``width``-word windows (a power of two) that occur twice or more, the first one included.

    Windows get exact ranks by doubling: a window of 2k words is the pair of ranks of its halves.
    """
    n = len(ids)
    if n <= width:
        return 0
    rank, size = ids, 1
    while size < width:
        pair = rank[:-size] * (int(rank.max()) + 1) + rank[size:]
        distinct, rank = np.unique(pair, return_inverse=True)
        if len(distinct) == len(rank):
            return 0
        size *= 2
    again = np.bincount(rank)[rank] > 1
    edge = np.zeros(n + 1, np.int64)
    edge[: len(again)] += again
    edge[width : width + len(again)] -= again
    return int((np.cumsum(edge)[:n] > 0).sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(lines) < 2:
        return 0
    lines = [x for x in lines if x.strip(BLANKS)]
    return len(lines) - len(set(lines))


def word_chars(text: str) -> int:
    return len(text) - sum(map(text.count, BLANKS))

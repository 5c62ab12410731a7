"""Ids of distinct strings, kept between batches of one worker."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from tidemark.llm import text_bytes as tb

Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class Known:
    """Ids of at most ``limit`` strings by their hash; beyond it, all are forgotten."""

    def __init__(self, encode: Encode, limit: int) -> None:
        self.encode, self.limit = encode, limit
        self._forget()

    def _forget(self) -> None:
        self.known, self.begin, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def _place(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> np.ndarray:
        """The place of each (distinct, sorted) string among the known, after encoding what is new."""
        if len(self.known) + len(h) > self.limit:
            self._forget()
        at = np.searchsorted(self.known, h)
        new = np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] != h) if len(self.known) else np.arange(len(h))
        if len(new):
            raw = data.tobytes()
            ids, sizes = self.encode([raw[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            self.begin = np.insert(self.begin, at[new], len(self.flat) + np.cumsum(sizes) - sizes)
            self.size, self.known = np.insert(self.size, at[new], sizes), np.insert(self.known, at[new], h[new])
            self.flat = np.concatenate([self.flat, ids])
        return np.searchsorted(self.known, h)

    def ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, firsts: np.ndarray,
            end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts made of the given strings, with an end id if one is named, and where each text's begin."""
        h, at, which = np.unique(tb.hashes(data, starts, ends, lower=False), return_index=True, return_inverse=True)
        place = self._place(data, starts[at], ends[at], h)[which]
        n = self.size[place]
        before = np.concatenate([[0], np.cumsum(n)])
        ids = self.flat[tb.runs(self.begin[place], n)]
        lengths = np.diff(before[firsts])
        if end_id is None:
            return ids, np.concatenate([[0], np.cumsum(lengths)])
        out_first = np.concatenate([[0], np.cumsum(lengths + 1)])
        out = np.full(out_first[-1], end_id, np.int32)
        body = np.ones(len(out), bool)
        body[out_first[1:] - 1] = False
        out[body] = ids
        return out, out_first

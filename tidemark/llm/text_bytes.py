"""Words of whole texts as numpy arrays: small helpers for use inside Arrow batches.

Everything works on the UTF-8 bytes of many texts laid end to end, so that the cost per text
is small. Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * _U(_BASE))


class Powers:
    """Powers of an odd base and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 20)
            inverse = pow(_BASE, -1, 1 << 64)
            for name, base in (("up", _BASE), ("down", inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_POWERS = Powers()


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = 1 << 20) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, their bytes, their bounds.

    A null is an empty text; a text longer than the limit is a run of its own.
    """
    base = 0
    for part in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        part = part.cast(pa.large_binary()) if not pa.types.is_large_binary(part.type) else part
        if part.null_count:
            part = part.fill_null(b"")
        n = len(part)
        if n:
            bounds = np.frombuffer(part.buffers()[1], np.int64)[part.offset:part.offset + n + 1]
            raw = part.buffers()[2]
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
            at = 0
            while at < n:
                end = max(at + 1, int(np.searchsorted(bounds, bounds[at] + limit, "right")) - 1)
                yield base + at, data[bounds[at]:bounds[end]], bounds[at:end + 1] - bounds[at]
                at = end
        base += n


IS_SIGN = np.ones(256, bool)
IS_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def words(data: np.ndarray, bounds: np.ndarray, signs: bytes = b"", between: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and where the words of each text begin (one more at the end).

    Words are also parted between an ASCII letter and one of ``signs``. ``between`` tells which
    bytes stand between words: white space, or with ``IS_SIGN`` all but letters and digits.
    """
    n = len(data)
    letter = ~between[data]
    head = letter.copy()
    head[1:] &= ~letter[:-1]
    tail = letter.copy()
    tail[:-1] &= ~letter[1:]
    if signs:
        kind = np.zeros(256, np.uint8)
        kind[[*range(65, 91), *range(97, 123)]], kind[list(signs)] = 1, 2
        kinds = kind[data]
        parted = (kinds[1:] | kinds[:-1]) == 3
        head[1:] |= parted
        tail[:-1] |= parted
    inner = bounds[(bounds > 0) & (bounds < n)]  # a word never crosses into the next text
    head[inner] = letter[inner]
    tail[inner - 1] = letter[inner - 1]
    starts, ends = np.flatnonzero(head), np.flatnonzero(tail) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes; with ``lower``, A-Z count as a-z."""
    up, down = _POWERS.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[LOWERED[data] if lower else data] * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(tokens: np.ndarray, firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of ``width`` words in each text, and where each text's begin.

    A text with fewer words, but one at least, is a single run.
    """
    n_words = np.diff(firsts)
    short = (n_words > 0) & (n_words < width)
    counts = np.where(short, 1, np.maximum(n_words - width + 1, 0))
    out_first = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out_first[1:])
    at = np.repeat(firsts[:-1] - out_first[:-1], counts) + np.arange(out_first[-1])
    left = np.minimum(np.repeat(firsts[1:], counts) - at, width)
    h = np.zeros(len(at), np.uint64)
    padded = np.concatenate([tokens, np.zeros(width, np.uint64)])
    for j in range(width):
        h = mix(h * _U(_BASE) + np.where(left > j, padded[at + j], _U(j)))
    return h, out_first


def runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], begin[0]+1, … size[0] numbers, then those of the next."""
    before = np.cumsum(size) - size
    return np.repeat(begin - before, size) + np.arange(int(size.sum()))

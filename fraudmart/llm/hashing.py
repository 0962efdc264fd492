"""Vectorised hashing of words, shingles and windows (numpy, inside tasks).

All hashes are the same in every process. Buffers are handled in blocks of
``BLOCK`` bytes, so memory stays bounded for texts of any length.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
BLOCK = 1 << 18
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


@lru_cache(maxsize=1)
def _break_table() -> np.ndarray:
    t = np.ones(256, dtype=bool)
    t[[0x20, *range(0x09, 0x0E)]] = False
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose every output bit depends on every input bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n (at least)."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up = np.full(size, U(base))
        down = np.full(size, U(pow(base, -1, 1 << 64)))
        up[0] = down[0] = U(1)
        have = _POWERS[base] = (np.cumprod(up), np.cumprod(down))
    return have


def windows(values: np.ndarray, width: int, base: int) -> np.ndarray:
    """Rabin-Karp hashes of every run of ``width`` values (polynomials modulo 2**64)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=U)
    if values.dtype != U:
        values = values.astype(U) + U(1)
    up, down = powers(base, len(values) + 1)
    acc = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * up[:len(values)], out=acc[1:])
    return mix((acc[width:] - acc[:-width]) * down[:n])


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words (runs of bytes that are not ASCII white space)."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = _break_table()[np.frombuffer(data, dtype=np.uint8)]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def _block_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    starts, ends = word_spans(data)
    if not len(starts):
        return np.empty(0, dtype=U), starts
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
    letters = np.frombuffer(data, dtype=np.uint8)[place + np.repeat(starts, sizes)]
    # a random-looking value for each (place, byte); no algebra links words of equal sums, as
    # it does for polynomials modulo 2**64, where long periodic words meet for every base
    values = mix((place.astype(U) << U(8) | letters) + U(BASES[0]))
    return mix(np.add.reduceat(values, first) ^ (sizes.astype(U) << U(48))), starts


def cuts(data: bytes) -> list[bytes]:
    """A long text in blocks cut at white space."""
    out, at = [], 0
    table = _break_table()
    while len(data) - at > BLOCK:
        end = at + BLOCK
        tail = table[np.frombuffer(data, dtype=np.uint8, count=BLOCK, offset=at)]
        gap = np.flatnonzero(~tail)
        if len(gap):
            end = at + int(gap[-1]) + 1
        else:  # one word longer than a block: up to its end
            while end < len(data) and table[data[end]]:
                end += 1
        out.append(data[at:end])
        at = end
    return [*out, data[at:]]


def word_hashes(docs: list[bytes]) -> list[np.ndarray]:
    """For each text the 64-bit hashes of its words, in order."""
    out: list[np.ndarray] = []
    batch: list[bytes] = []
    size = 0

    def flush():
        nonlocal batch, size
        if not batch:
            return
        h, starts = _block_hashes(b" ".join(batch))
        edges = np.cumsum([0] + [len(x) + 1 for x in batch])
        at = np.searchsorted(starts, edges)
        out.extend(h[a:b] for a, b in zip(at[:-1], at[1:]))
        batch, size = [], 0

    for d in docs:
        if len(d) > BLOCK:
            flush()
            out.append(np.concatenate([_block_hashes(x)[0] for x in cuts(d)]))
            continue
        batch.append(d)
        size += len(d)
        if size > BLOCK:
            flush()
    flush()
    return out


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles, in order; fewer words make one shingle; no words, none."""
    if len(words) == 0:
        return words
    n = min(n, len(words))
    m = len(words) - n + 1
    h = mix(words[:m] + U(n))
    for j in range(1, n):
        h = mix(h * U(BASES[1]) + words[j:j + m])
    return h


def sliding_owner(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the position of its least one (leftmost
    of equals; values are compared by their upper 40 bits)."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64)
    step = (1 << 24) - width
    parts = []
    for at in range(0, n, step):
        v = values[at:at + step + width - 1]
        parts.append(at + _owner(v, width))
    return np.concatenate(parts)


def _owner(v: np.ndarray, width: int) -> np.ndarray:
    n = len(v) - width + 1
    low = U((1 << 24) - 1)
    key = (v & ~low) | np.arange(len(v), dtype=U)
    pad = -len(key) % width
    rows = np.concatenate([key, np.full(pad, ~U(0))]).reshape(-1, width)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return (np.minimum(tail[:n], head[width - 1:width - 1 + n]) & low).astype(np.int64)


def owner_runs(owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of windows with one owner: first window, end (exclusive), owner."""
    if not len(owner):
        e = np.empty(0, dtype=np.int64)
        return e, e, e
    first = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
    return first, np.append(first[1:], len(owner)), owner[first]

"""Edit distance of many pairs at once: banded, bit-parallel, vectorised over the pairs."""

from __future__ import annotations

import numpy as np

ONE = np.uint64(1)
TOP = np.uint64(63)
PAIRS, CELLS = 4096, 1 << 21  # pairs, and padded bytes, worked at once


def padded(rows: list, width: int, fill: int) -> np.ndarray:
    """Bytes, or arrays of ids from 0, one row each."""
    out = np.full((len(rows), width), fill, dtype=np.int32)
    for i, r in enumerate(rows):
        out[i, : len(r)] = np.frombuffer(r, np.uint8) if isinstance(r, bytes) else r
    return out


def within(a: list, b: list, limit: int) -> np.ndarray:
    """For each pair: is the Levenshtein distance at most ``limit`` (up to 31)? Pairs of bytes, or
    of arrays of word ids (equal words, equal ids).

    Hyyro's bit-vector recurrence on a band of rows about the diagonal: bit 63 of a word
    is row ``column + limit``. The score is followed down the band's lowest diagonal,
    then along the last row. Pairs are worked in order of length, so that padding stays
    small.
    """
    out = np.zeros(len(a), dtype=bool)
    long = [x if len(x) >= len(y) else y for x, y in zip(a, b)]
    short = [y if len(x) >= len(y) else x for x, y in zip(a, b)]
    n_long = np.array([len(x) for x in long], dtype=np.int64)
    n_short = np.array([len(x) for x in short], dtype=np.int64)
    todo = np.flatnonzero(n_long - n_short <= limit)
    trivial = n_long[todo] <= limit
    out[todo[trivial]] = True
    todo = todo[~trivial]
    todo = todo[np.argsort(n_long[todo], kind="stable")]
    lo = 0
    while lo < len(todo):
        hi = min(lo + PAIRS, len(todo))
        while hi > lo + 1 and (hi - lo) * int(n_long[todo[hi - 1]]) > CELLS:  # the longest of the part pads it
            hi = lo + (hi - lo) // 2
        at = todo[lo:hi]
        out[at] = _band([long[i] for i in at], [short[i] for i in at], n_long[at], n_short[at], limit)
        lo = hi
    return out


def _band(rows: list[bytes], cols: list[bytes], n: np.ndarray, m: np.ndarray, limit: int) -> np.ndarray:
    """Distance <= limit of patterns ``rows`` (lengths n > limit) and texts ``cols`` (lengths m <= n)."""
    k = len(rows)
    span = -(-(2 * limit + 1) // 8) * 8  # rows of the band, in whole bytes
    pattern = np.full((k, limit + int(n.max()) + span), -1, dtype=np.int32)
    pattern[:, limit : limit + int(n.max())] = padded(rows, int(n.max()), -1)
    text = padded(cols, max(1, int(m.max())), -2)
    band = np.zeros((k, 8), dtype=np.uint8)
    vp = np.full(k, (1 << 64) - (1 << (63 - limit)), dtype=np.uint64)
    vn = np.zeros(k, dtype=np.uint64)
    score = np.full(k, limit, dtype=np.int64)
    across = np.full(k, 62, dtype=np.int64)
    live = np.ones(k, dtype=bool)
    with np.errstate(over="ignore"):
        for j in range(int(m.max())):
            band[:, : span // 8] = np.packbits(pattern[:, j : j + span] == text[:, j : j + 1], axis=1, bitorder="little")
            eq = band.view("<u8")[:, 0] << np.uint64(63 - 2 * limit)  # row j - limit + d is bit 63 - 2 * limit + d
            d0 = (((eq & vp) + vp) ^ vp) | eq | vn
            hp = vn | ~(d0 | vp)
            hn = d0 & vp
            on = j < m
            down = on & (j < n - limit)
            score += down & ((d0 >> TOP) == 0)
            last = on & ~down
            if last.any():
                bit = np.maximum(across, 0).astype(np.uint64)
                score += np.where(last, ((hp >> bit) & ONE).astype(np.int64) - ((hn >> bit) & ONE).astype(np.int64), 0)
                across -= last
            half = d0 >> ONE
            vp, vn = hn | ~(half | hp), half & hp
            live &= ~down | (score <= 2 * limit + (n - m) + 1)
            if not live.any():
                break
    return live & (score <= limit)


def close(a, b, limit: int) -> bool:
    """Is the Levenshtein distance of two sequences at most ``limit``, whatever that is?

    Furthest-reaching rows per diagonal, one more edit a round (Ukkonen, Myers).
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return False
    gap = m - n
    far = {}  # diagonal (place in b - place in a) -> places of a used up
    for e in range(limit + 1):
        new = {}
        # diagonals from which the edits left reach the last one
        for d in range(max(-e, gap - limit + e), min(e, gap + limit - e) + 1):
            if e == 0:
                i = 0
            else:
                i = max(far.get(d, -2) + 1, far.get(d - 1, -2), far.get(d + 1, -2) + 1)
            i = min(i, n, m - d)
            if i < 0 or i + d < 0:
                continue
            while i < n and i + d < m and a[i] == b[i + d]:
                i += 1
            if i == n and i + d == m:
                return True
            new[d] = i
        far = new
    return False

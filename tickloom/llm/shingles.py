"""Word shingles of many texts at once, as sorted 64-bit hashes."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SHINGLE = 5
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_K = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, _P, dtype=np.uint64), np.full(n, _P_INV, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def shingle_sets(texts: list[str | None], width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, offsets): document i's distinct shingles are ``hashes[offsets[i]:offsets[i + 1]]``, ascending.

    Words are runs without the blanks 0x20 and 0x09 to 0x0D, with A-Z lower-cased. A text with
    fewer than ``width`` words is one shingle of all its words; without words its set is empty.
    """
    data = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    sizes = np.array([len(d) + 1 for d in data], dtype=np.int64)
    buf = np.frombuffer(b"\n".join(data) + b"\n", dtype=np.uint8) if data else np.zeros(1, np.uint8)
    doc_start = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(sizes, out=doc_start[1:])
    blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(n + 1, np.int64)
    up, down = _powers(1 << max(19, int(len(buf)).bit_length()))
    lower = buf + ((buf >= 65) & (buf <= 90)) * np.uint8(32)
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=total[1:])
    word = mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    doc = np.searchsorted(doc_start, starts, side="right") - 1
    words_in = np.bincount(doc, minlength=n)
    first = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(words_in, out=first[1:])
    rolled = np.zeros(max(0, len(word) - width + 1), dtype=np.uint64)
    for j in range(width):
        rolled = rolled * _K + word[j : j + len(rolled)]
    rolled = mix(rolled)
    out, lengths = [], np.zeros(n, dtype=np.int64)
    for i in range(n):
        w = words_in[i]
        if w >= width:
            got = np.unique(rolled[first[i] : first[i + 1] - width + 1])
        elif w:
            h = np.uint64(w)
            with np.errstate(over="ignore"):
                for x in word[first[i] : first[i + 1]]:
                    h = h * _K + x
            got = mix(np.array([h], dtype=np.uint64))
        else:
            continue
        out.append(got)
        lengths[i] = len(got)
    offsets = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    return np.concatenate(out), offsets


def minwise(hashes: np.ndarray, offsets: np.ndarray, trees: int) -> np.ndarray:
    """The ``trees`` minwise tokens of each non-empty set, rows in order of the non-empty sets."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    out = np.empty((len(starts), trees), dtype=np.uint64)
    for t in range(trees):
        salt = mix(np.array([t + 1], dtype=np.uint64))[0]
        out[:, t] = np.minimum.reduceat(mix(hashes ^ salt), starts)
    return out


def fingerprint(hashes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each non-empty set."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    return tuple(np.add.reduceat(mix(hashes + np.uint64(s)), starts) for s in (0x1234567, 0x89ABCDEF))

"""Vectorised word and shingle hashes of many texts at once (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
INVERSE = U(pow(int(BASE), -1, 1 << 64))
SLICE_CHARS = 400_000
_powers = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        for k, b in enumerate((BASE, INVERSE)):
            t = np.full(size, b, U)
            t[0] = 1
            _powers[k] = np.multiply.accumulate(t)
    return _powers[0], _powers[1]


def slices(batch, column: int, chars: int = SLICE_CHARS):
    """Parts of an Arrow batch with about ``chars`` bytes of text each, at least one row: the arrays of a part, some
    forty times its text, bound the memory of a task, apart from single long texts."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, have = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and have + n > chars:
            yield batch.slice(start, i - start)
            start, have = i, 0
        have += n + 1
    if start < batch.num_rows:
        yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection that spreads every input bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word (runs of anything but space and \\t..\\r, A-Z lower-cased) of all texts in order, and
    the offsets of each text's words: words of text i are hashes[offsets[i]:offsets[i + 1]]."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join(raw) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = ~space
    starts = np.flatnonzero(inside & np.concatenate(([True], space[:-1])))
    ends = np.flatnonzero(inside & np.concatenate((space[1:], [True]))) + 1
    power, inverse = _power_tables(len(data) + 1)
    total = np.zeros(len(data) + 1, U)
    np.cumsum((data.astype(U) + U(1)) * power[:len(data)], out=total[1:])
    hashes = mix((total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))
    text_ends = np.cumsum([len(r) + 1 for r in raw]) if raw else np.zeros(0, np.int64)
    offsets = np.concatenate(([0], np.searchsorted(starts, text_ends))).astype(np.int64)
    return hashes, offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``width``-word shingles in order and the number of the text of each; a text of fewer words (but
    at least one) has its whole sequence as its one shingle."""
    counts = np.diff(offsets)
    own = np.repeat(np.arange(len(counts)), counts)
    out = np.zeros(max(0, len(hashes) - width + 1), U)
    for k in range(width):
        out += mix(hashes[k:len(out) + k] + U(k + 1)) * U((2 * k + 3) * 0x9E3779B1)
    out = mix(out)
    keep = own[:len(out)] == own[width - 1:] if len(hashes) >= width else np.zeros(0, bool)
    texts, values = own[:len(out)][keep], out[keep]
    few = np.flatnonzero((counts > 0) & (counts < width))
    if len(few):
        short = np.zeros(len(few), U)
        for k in range(width - 1):
            has = counts[few] > k
            short[has] += mix(hashes[offsets[few[has]] + k] + U(k + 101)) * U(2 * k + 7)
        short = mix(short + counts[few].astype(U))
        texts, values = np.concatenate((texts, few)), np.concatenate((values, short))
        order = np.argsort(texts, kind="stable")
        texts, values = texts[order], values[order]
    return values, texts


def stretches(hashes: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from every place on."""
    power, inverse = _power_tables(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * power[:len(hashes)], out=total[1:])
    return mix((total[places + size] - total[places]) * inverse[places])


def unique_sets(values: np.ndarray, texts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and the offsets of the texts' sets."""
    order = np.lexsort((values, texts))
    values, texts = values[order], texts[order]
    first = np.ones(len(values), bool)
    first[1:] = (values[1:] != values[:-1]) | (texts[1:] != texts[:-1])
    values, texts = values[first], texts[first]
    return values, np.searchsorted(texts, np.arange(n + 1)).astype(np.int64)


def fold(values: np.ndarray, offsets: np.ndarray, seed: int) -> np.ndarray:
    """One 64-bit hash per set: sum of the mixed members (0 for an empty set)."""
    total = np.concatenate((np.zeros(1, U), np.cumsum(mix(values + U(seed)))))
    return total[offsets[1:]] - total[offsets[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)

"""Hashed word and character shingles of whole texts, on numpy arrays inside tasks.

A text is read as UTF-8 bytes in slices that end between words, so the working arrays
stay small however long the text is; only eight bytes per word are kept.
"""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so powers of it have inverses modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

# White space of the word contracts: space and the controls from tab to carriage return.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _powers(base: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(size, base, dtype=_U64)
        steps[0] = 1
        return np.cumprod(steps, dtype=_U64)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, up to at least `size`."""
    held = max(_TABLES, default=0)
    if held < size:
        held = max(size, 2 * held, 1 << 14)
        _TABLES.clear()
        _TABLES[held] = (_powers(_BASE, held), _powers(_INVERSE, held))
    return _TABLES[held]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (the splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> _U64(30))
        x *= _U64(0xBF58476D1CE4E5B9)
        x ^= x >> _U64(27)
        x *= _U64(0x94D049BB133111EB)
        x ^= x >> _U64(31)
    return x


def _hash_slice(data: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word of the lower-cased bytes."""
    space = _SPACE[data]
    edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if not len(starts):
        return np.empty(0, dtype=_U64)
    power, inverse = _tables(len(data) + 1)
    with np.errstate(over="ignore"):
        terms = (_LOWER[data].astype(_U64) + _U64(1)) * power[: len(data)]
        sums = np.concatenate((np.zeros(1, dtype=_U64), np.cumsum(terms, dtype=_U64)))
        return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U64))


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z lowered, in order."""
    if not text:
        return np.empty(0, dtype=_U64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if len(data) <= SLICE_BYTES:
        return _hash_slice(data)
    parts, at = [], 0
    while at < len(data):
        end = min(at + SLICE_BYTES, len(data))
        while end < len(data):  # go on to the end of the word
            gap = np.flatnonzero(_SPACE[data[end : end + SLICE_BYTES]])
            if len(gap):
                end += int(gap[0])
                break
            end = min(end + SLICE_BYTES, len(data))
        parts.append(_hash_slice(data[at:end]))
        at = end
    return np.concatenate(parts)


def rolled(hashes: np.ndarray, width: int) -> np.ndarray:
    """One hash per run of `width` neighbours, in order; fewer hashes make one run."""
    if not len(hashes):
        return hashes
    width = min(width, len(hashes))
    count = len(hashes) - width + 1
    with np.errstate(over="ignore"):
        out = np.full(count, width, dtype=_U64)
        for i in range(width):
            out = mixed(out * _U64(_BASE) + hashes[i : i + count])
    return out


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The distinct word shingles of the text as sorted 64-bit hashes."""
    return np.unique(rolled(word_hashes(text), width))


def char_shingles(lines: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` characters of each line, in order, and their number per line.

    Lines hold no line break; lines shorter than `width` have none.
    """
    lengths = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    counts = np.maximum(lengths - width + 1, 0)
    codes = np.frombuffer("\n".join(lines).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(_U64)
    if not counts.sum():
        return np.empty(0, dtype=_U64), counts
    with np.errstate(over="ignore"):
        # Runs of 1, 2, 4, ... characters make up the width, by its binary digits.
        rolling, run, wide, at = np.zeros(len(codes) - width + 1, dtype=_U64), codes, 1, 0
        while wide <= width:
            power = _U64(pow(_BASE, wide, 1 << 64))
            if width & wide:
                rolling *= power
                rolling += run[at : at + len(rolling)]
                at += wide
            if 2 * wide <= width:
                longer = run[:-wide] * power
                longer += run[wide:]
                run = longer
            wide *= 2
        rolling = mixed(rolling)
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    first = np.cumsum(counts) - counts
    at = np.repeat(starts - first, counts) + np.arange(counts.sum())
    return rolling[at], counts


def overlap(left: np.ndarray, right: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    at = np.searchsorted(right, left)
    at[at == len(right)] = 0
    return int(np.count_nonzero(right[at] == left))


class UniversalHashes:
    """`count` functions x -> (a*x + b) mod 2**64 with odd a; their minima make signatures."""

    def __init__(self, count: int, seed: int):
        state = np.random.Generator(np.random.PCG64(seed))
        self.a = state.integers(0, 1 << 63, count, dtype=_U64) * _U64(2) + _U64(1)
        self.b = state.integers(0, 1 << 63, count, dtype=_U64)

    def minima(self, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Minima per function (rows) over the segments of `values` that begin at `starts`.

        Segments are not empty. Sixteen bits of each minimum are returned, which tell different
        minima apart well enough; not the highest ones, as those are small in every minimum.
        """
        out = np.empty((len(self.a), len(starts)), dtype=np.uint16)
        with np.errstate(over="ignore"):
            for i, (a, b) in enumerate(zip(self.a, self.b, strict=True)):
                out[i] = (np.minimum.reduceat(values * a + b, starts) >> _U64(16)).astype(np.uint16)
        return out

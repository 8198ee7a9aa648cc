"""Vectorised hashing and winnowing over the buffers of Arrow string columns.

A batch of texts is handled as one byte array with offsets, so no Python object is made for a
word or a byte.  Two kinds of hashes are kept apart.  ``Prefix`` gives cheap polynomials modulo
2**64, which made-up texts can bring to collide: they number the features of models, where a
collision is harmless.  ``word_hashes`` and ``Ranges`` mix without such algebra and are what
decides whether words and windows are equal.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_RADIX = 0x9E3779B97F4A7C15 | 1
_RADIX_INVERSE = pow(_RADIX, -1, 2**64)
_SYMBOLS = np.random.default_rng(20240917).integers(1, 2**63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string or binary array; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int):
    """Row ranges of about ``most`` bytes each; a longer row gets a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finishing step, so that low bits depend on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _table(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.cumprod(steps, dtype=np.uint64)
        if size <= 1 << 24:
            _powers[name] = have
    return have[:n]


class Prefix:
    """Prefix sums from which the hash of any range of a symbol sequence follows."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * _table("up", _RADIX, n), out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        inverse = _table("down", _RADIX_INVERSE, len(self.sums))
        return mix((self.sums[end] - self.sums[start]) * inverse[start] + (end - start).astype(np.uint64))

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all ranges of length k (n - k + 1 of them)."""
        n = len(self.sums) - 1
        if n < k:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[: n - k + 1]) * _table("down", _RADIX_INVERSE, n - k + 1))


def blend(left: np.ndarray, right: np.ndarray, salt: int) -> np.ndarray:
    """One hash of two, in this order; every bit of both reaches every bit of it."""
    x = left * np.uint64(0xA24BAED4963EE407)
    y = right * np.uint64(0x9FB21C651E98DF25)
    x ^= x >> np.uint64(29)
    y ^= y >> np.uint64(32)
    x += y
    x += np.uint64(salt)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


class Ranges:
    """Hashes of ranges of a symbol sequence, from ranges of half the length up.

    A range of n symbols is two overlapping ranges of the greatest power of two in n; of the
    powers only those that ``sizes`` of ranges need are kept.
    """

    def __init__(self, symbols: np.ndarray, sizes: tuple[int, ...], salt: int = 0):
        need = {n.bit_length() - 1 for n in sizes}
        self.n, self.salt, self.levels = len(symbols), salt, {}
        lowest = 3 if symbols.dtype == np.uint8 and min(need) >= 3 else 0
        level = _eights(symbols) if lowest else symbols.astype(np.uint64)  # eight bytes are one number
        level = mix(level + np.uint64((salt + 1) * 0x9E3779B97F4A7C15 % 2**64))
        for power in range(lowest, max(need) + 1):
            if power > lowest:
                half = 1 << (power - 1)
                level = blend(level[: max(0, len(level) - half)], level[half:], salt)
            if power in need:
                self.levels[power] = level

    def grams(self, k: int) -> np.ndarray:
        """Hashes of all ranges of length k (n - k + 1 of them)."""
        if self.n < k:
            return np.zeros(0, np.uint64)
        power = k.bit_length() - 1
        level, count = self.levels[power], self.n - k + 1
        if 1 << power == k:
            return level[:count]
        return blend(level[:count], level[k - (1 << power) :][:count], self.salt + k)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the ranges [start, end), whose lengths must be among the sizes' powers."""
        size = end - start
        out = np.empty(len(start), np.uint64)
        for power, level in self.levels.items():
            some = np.flatnonzero((size >> power) == 1)
            if len(some):
                out[some] = blend(level[start[some]], level[end[some] - (1 << power)], self.salt)
        out += size.astype(np.uint64)
        return mix(out)


def _eights(data: np.ndarray) -> np.ndarray:
    """Each eight consecutive bytes as one number."""
    data = np.ascontiguousarray(data)
    return np.ndarray((max(0, len(data) - 7),), "<u8", data, 0, (1,)).astype(np.uint64) if len(data) >= 8 else np.zeros(0, np.uint64)


_PIECE_MASK = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """A hash of each word's bytes: pieces of eight bytes, chained by mixing; words over 64 bytes by a digest."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    pieces = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from every place on
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64((salt + 1) * 0xC2B2AE3D27D4EB4F % 2**64))
    short = size <= 64
    at = np.flatnonzero(short)
    place, left = starts[at], size[at]
    while len(at):
        piece = pieces[place] & _PIECE_MASK[np.minimum(left, 8)]
        out[at] = blend(out[at], piece, salt)
        more = left > 8
        at, place, left = at[more], place[more] + 8, left[more] - 8
    for i in np.flatnonzero(~short):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=salt.to_bytes(8, "big")).digest()
        out[i] = np.uint64(int.from_bytes(digest, "little"))
    return mix(out)


def byte_prefix(data: np.ndarray) -> Prefix:
    return Prefix(_SYMBOLS[data])


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive values, by doubling."""
    out, width = values, 1
    while width < w:
        step = min(width, w - width)
        out = np.minimum(out[: len(out) - step], out[step:])
        width += step
    return out


def owned_windows(grams: np.ndarray, offsets: np.ndarray, k: int, length: int):
    """Deals out all windows of ``length`` symbols of each row to anchors.

    ``grams`` has the hash of the k-gram at each position of the concatenated rows (any value
    where a k-gram would cross a row's end).  The anchor of a window is the first k-gram with the
    least hash in it, so equal windows have equal anchors at equal places.  Returns for each
    anchor: row, its position, first window, number of (consecutive) windows, positions counted
    over the concatenated rows.
    """
    w, lengths = length - k + 1, np.diff(offsets)
    long = np.flatnonzero(lengths >= length)
    none = np.zeros(0, np.int64)
    if not len(long):
        return none, none, none, none
    least = sliding_min(grams, w)
    marks = np.zeros(len(grams) + 1, np.int8)
    first, after = offsets[long], offsets[long] + lengths[long] - length + 1
    np.add.at(marks, first, 1)
    np.add.at(marks, after, -1)
    ok = np.cumsum(marks, dtype=np.int8)[: len(least)] > 0
    new = np.empty(len(least), bool)
    new[0] = True
    new[1:] = (least[1:] != least[:-1]) | (grams[: len(least) - 1] == least[:-1])
    new[first] = True
    new &= ok
    starts = np.flatnonzero(new)
    row = np.searchsorted(offsets, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(grams)), offsets[row] + lengths[row] - length + 1)
    at, ahead = np.empty_like(starts), np.arange(w)
    for i in range(0, len(starts), 1 << 14):
        some = starts[i : i + (1 << 14)]
        at[i : i + (1 << 14)] = some + grams[some[:, None] + ahead].argmin(1)
    return row, at, starts, ends - starts


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end bytes of the words ``[^\\x20\\x09-\\x0D]+`` of all rows, and row borders in words."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    here, before = inside[1:], inside[:-1]
    starts = np.flatnonzero(here & (~before | border))
    ends = np.flatnonzero(before & (~here | border))
    return starts, ends, np.searchsorted(starts, offsets, "left")

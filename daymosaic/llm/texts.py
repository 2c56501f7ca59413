"""Words of whole Arrow columns as 64-bit hashes, by array operations.

Every byte of a word contributes a fixed random number times a power of an odd
base, modulo 2**64; a cumulative sum then gives the hash of any stretch of
bytes, so no word becomes a Python object. Two different words of a vocabulary
of a hundred million share a hash with a probability below one in a thousand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: bytes hashed at once; stretches end between words
STRETCH = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_RANDOM = np.random.Generator(np.random.PCG64(20260101)).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers = {"base": np.ones(1, np.uint64), "inverse": np.ones(1, np.uint64)}


def letters(separators: bytes, lower: bool = True) -> np.ndarray:
    """Byte to byte: 0 for ``separators``, lower case for A-Z when ``lower``.

    UTF-8 bytes above 127 stay, so separators are ASCII. A zero byte that is no
    separator becomes 0x7F's neighbour 0xFF, which UTF-8 never uses.
    """
    to = np.arange(256, dtype=np.uint8)
    to[0] = 0xFF
    if lower:
        to[65:91] += 32
    to[np.frombuffer(separators, np.uint8)] = 0
    return to


#: words are runs of anything but blanks
BLANK_WORDS = letters(b"\x20\x09\x0a\x0b\x0c\x0d")
#: words are runs of a-z, 0-9 and all that is not ASCII
PLAIN_WORDS = letters(bytes(b for b in range(128) if not chr(b).isalnum()))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        factor = np.full(max(n, STRETCH + 4096), _BASE if kind == "base" else _INVERSE, np.uint64)
        factor[0] = 1
        _powers[kind] = np.cumprod(factor, dtype=np.uint64)
    return _powers[kind][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def word_places(data: np.ndarray, offsets: np.ndarray, to: np.ndarray):
    """Yields (mapped bytes, first, starts, ends) for stretches; places count from ``first``."""
    first, n = 0, len(data)
    while first < n:
        last = min(n, first + STRETCH)
        while last < n:  # on to the next separator or text
            block = to[data[last: last + 4096]]
            stop = np.flatnonzero(block == 0)
            nearest = last + (int(stop[0]) if len(stop) else len(block))
            following = offsets[np.searchsorted(offsets, last)]
            last = int(min(nearest, following, n))
            if len(stop) or last == following:
                break
        mapped = to[data[first:last]]
        inside = mapped != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        edges = offsets[np.searchsorted(offsets, first, "right"): np.searchsorted(offsets, last)] - first
        edges = edges[(edges > 0) & (edges < len(mapped))]
        begins[edges] = inside[edges]
        finish[edges - 1] = inside[edges - 1]
        yield mapped, first, np.flatnonzero(begins), np.flatnonzero(finish) + 1
        first = last


def hashes_of(mapped: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each stretch [start, end) of ``mapped``."""
    total = np.zeros(len(mapped) + 1, np.uint64)
    np.cumsum(_RANDOM[mapped] * _power("base", len(mapped)), dtype=np.uint64, out=total[1:])
    return mix((total[ends] - total[starts]) * _power("inverse", len(mapped) + 1)[starts])


def word_hashes(column: pa.Array, to: np.ndarray = BLANK_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, first word of each text and the end)."""
    data, offsets = buffers(column)
    found, counts = [np.zeros(0, np.uint64)], np.zeros(len(offsets) - 1, np.int64)
    for mapped, first, starts, ends in word_places(data, offsets, to):
        found.append(hashes_of(mapped, starts, ends))
        text = np.searchsorted(offsets, starts + first, "right") - 1
        counts += np.bincount(text, minlength=len(counts))
    return np.concatenate(found), np.concatenate([[0], np.cumsum(counts)])


def sequence_hashes(words: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words that begin at each place of ``first``."""
    total = np.full(len(first), n, np.uint64)
    for k in range(n):
        total = mix(total * np.uint64(0xD1342543DE82EF95) + words[first + k])
    return total


def window_starts(offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, place) of every run of ``n`` words that lies within one text."""
    length = np.maximum(np.diff(offsets) - n + 1, 0)
    text = np.repeat(np.arange(len(length)), length)
    begin = np.concatenate([[0], np.cumsum(length)])[:-1]
    return text, np.arange(len(text)) - np.repeat(begin, length) + np.repeat(offsets[:-1], length)

"""Vectorised word and shingle hashes of UTF-8 texts (numpy, inside tasks).

Words are runs of bytes that are not ASCII white space, so they can be
found on the UTF-8 bytes.  A word's hash is the sum, modulo 2**64, of its
bytes' random values times a random number of their place (longer words
than the table of places: BLAKE2b), mixed at the end.  Places have unrelated numbers, so
no pattern of repeated letters makes two words collide whatever the
numbers are, as it does for polynomials modulo a power of two.  Two
different words, or windows, agree with a probability of about 2**-60.
Texts are handled in pieces of about a megabyte cut at white space, so
memory does not follow the length of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .bloom import mix64

PIECE = 1 << 20
PLACES = 1 << 12
_VALUES = mix64(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_AT = mix64(np.arange(1 << 32, (1 << 32) + PLACES, dtype=np.uint64)) | np.uint64(1)

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def joined_hashes(data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """64-bit hashes of words of so many bytes each (none empty), joined in ``data``."""
    if not len(sizes):
        return np.empty(0, dtype=np.uint64)
    offsets = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    place = np.arange(int(sizes.sum())) - np.repeat(offsets, sizes)
    values = _VALUES[data] * _AT[place & (PLACES - 1)]
    hashes = np.add.reduceat(values, offsets) + sizes.astype(np.uint64)
    for i in np.flatnonzero(sizes > PLACES):
        digest = hashlib.blake2b(data[offsets[i]:offsets[i] + sizes[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return mix64(hashes)


def _piece_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of one piece; a word ends at a break."""
    word = np.zeros(len(data) + 1, dtype=bool)
    word[:-1] = ~IS_SPACE[data]
    start = word.copy()
    start[1:] &= ~word[:-1]
    stop = word[:-1] & ~word[1:]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    start[inner] = word[inner]
    stop[inner - 1] = word[inner - 1]
    starts, ends = np.flatnonzero(start[:-1]), np.flatnonzero(stop) + 1
    if not len(starts):
        return starts, ends, np.empty(0, dtype=np.uint64)
    return starts, ends, joined_hashes(data[word[:-1]], ends - starts)


def _cut(data: np.ndarray, at: int) -> int:
    """End of the piece that begins at ``at``: just after white space, or the end."""
    size = PIECE
    while at + size < len(data):
        spaces = np.flatnonzero(IS_SPACE[data[at:at + size]])
        if len(spaces):
            return at + int(spaces[-1]) + 1
        size *= 2
    return len(data)


def words_of(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (byte positions) and 64-bit hashes of all words of ``data``."""
    if len(data) <= PIECE:
        return _piece_words(data, breaks)
    found, at = [], 0
    while at < len(data):
        end = _cut(data, at)
        starts, ends, hashes = _piece_words(data[at:end], breaks - at)
        found.append((starts + at, ends + at, hashes))
        at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (order matters)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        total += _AT[PLACES - 1 - j] * hashes[j:j + n]
    return mix64(total + np.uint64(k))


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls are empty texts."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, dtype=np.uint8)
    return offsets, data


def documents(column: pa.Array, lower: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per row: (row, bytes, word starts, word ends, word hashes).

    Starts and ends are relative to the row's bytes.  Rows are hashed
    together in runs of about a piece; a longer text goes alone.
    """
    if not len(column):
        return
    offsets, data = texts(column)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + PIECE, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        block = data[offsets[row]:offsets[last]]
        if lower:
            block = LOWER[block]
        edges = offsets[row:last + 1] - offsets[row]
        starts, ends, hashes = words_of(block, edges)
        cuts = np.searchsorted(starts, edges)
        for i in range(last - row):
            a, b = cuts[i], cuts[i + 1]
            yield (row + i, block[edges[i]:edges[i + 1]], starts[a:b] - edges[i],
                   ends[a:b] - edges[i], hashes[a:b])
        row = last

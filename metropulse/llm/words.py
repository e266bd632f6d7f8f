"""Vectorised words and word n-grams of Arrow text columns.

A word is a run of bytes other than space and 0x09-0x0D, with A-Z lower-cased. It is known by a 64-bit hash: the
sum over its bytes of a random number for the byte times an odd base to the byte's place, mixed at the end.
Work runs over slices of a few megabytes, so memory follows the slice and not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C1B


def _stream(seed: int, n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE = np.where(SEPARATOR, np.uint64(0), _stream(7, 256)[LOWER])
_powers = np.array([1], dtype=np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 4096), _BASE & _M64, dtype=np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes; a longer text is a range of its own."""
    _, at = text_bytes(column)
    first, n = 0, len(at) - 1
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def _pieces(raw: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cuts in front of separators, about ``limit`` bytes apart."""
    start = 0
    while start < len(raw):
        end = start + limit
        while end < len(raw):
            found = np.flatnonzero(SEPARATOR[raw[end : end + limit]])
            if len(found):
                end += int(found[0])
                break
            end += limit
        yield start, min(end, len(raw))
        start = end


def word_hashes(column: pa.Array, endings: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all words in order, the n + 1 word offsets of the rows and, if asked for, a code below ``endings`` of
    each word's last three bytes."""
    raw, at = text_bytes(column)
    hashes, begins, codes = [], [], []
    for start, end in _pieces(raw, SLICE_BYTES // 4):  # some twelve numbers are held for each byte of a piece
        part = raw[start:end]
        gap = SEPARATOR[part]
        word = ~gap
        opens = word.copy()
        opens[1:] &= gap[:-1]
        inner = at[np.searchsorted(at, start) : np.searchsorted(at, end)] - start
        opens[inner] = word[inner]  # a text's first word is cut off from the text before it
        begin = np.flatnonzero(opens)
        if not len(begin):
            continue
        closes = word
        closes[:-1] &= gap[1:] | opens[1:]
        size = np.flatnonzero(closes) - begin + 1
        first = begin[0]
        place = np.arange(first, len(part)) - np.repeat(begin, np.diff(begin, append=len(part)))
        sums = np.add.reduceat(_BYTE[part[first:]] * _power(int(place.max()) + 1)[place], begin - first)
        hashes.append(mix(sums + size.astype(np.uint64)))
        begins.append(begin + start)
        if endings:
            last = begin + size - 1
            code = LOWER[part[last]].astype(np.uint64)
            for back in (1, 2):
                byte = LOWER[part[np.maximum(last - back, 0)]].astype(np.uint64)
                code = code * np.uint64(257) + np.where(size > back, byte + np.uint64(1), np.uint64(0))
            codes.append((mix(code) % np.uint64(endings)).astype(np.int32))
    word_at = np.concatenate(begins) if begins else np.zeros(0, dtype=np.int64)
    return (
        np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64),
        np.searchsorted(word_at, at).astype(np.int64),
        np.concatenate(codes) if codes else np.zeros(0, dtype=np.int32),
    )


def _chain(hashes: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    s = np.full(len(first), width, dtype=np.uint64)
    for j in range(width):
        s = (s ^ (s >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) + hashes[first + j]
    return mix(s)


def shingle_sets(column: pa.Array, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row after the other, and the n + 1 offsets of the rows.
    A text with fewer words than ``width`` is one shingle; a text without words has none."""
    hashes, at, _ = word_hashes(column)
    counts = np.diff(at)
    row = np.repeat(np.arange(len(counts)), np.maximum(counts - width + 1, 0))
    made = np.flatnonzero(np.arange(len(hashes)) + width <= np.repeat(at[1:], counts))
    parts, rows = [_chain(hashes, made, width)], [row]
    for short in range(1, width):
        which = np.flatnonzero(counts == short)
        parts.append(_chain(hashes, at[which], short))
        rows.append(which)
    shingles, row = np.concatenate(parts), np.concatenate(rows)
    if not len(shingles):
        return shingles, np.zeros(len(counts) + 1, dtype=np.int64)
    order = np.argsort(row, kind="stable")
    shingles, row = shingles[order], row[order]
    bounds = np.searchsorted(row, np.arange(len(counts) + 1))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        shingles[a:b].sort()
    keep = np.ones(len(shingles), dtype=bool)
    keep[1:] = (shingles[1:] != shingles[:-1]) | (row[1:] != row[:-1])
    return shingles[keep], np.searchsorted(row[keep], np.arange(len(counts) + 1)).astype(np.int64)


def set_digests(sets: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each set; 0, 0 for the empty set."""
    sizes = np.diff(at)
    full = sizes > 0
    out = []
    for seed in (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179):
        d = np.zeros(len(sizes), dtype=np.uint64)
        if full.any():
            d[full] = mix(np.add.reduceat(mix(sets ^ np.uint64(seed)), at[:-1][full]) + sizes[full].astype(np.uint64))
        out.append(d.view(np.int64))
    return out[0], out[1]

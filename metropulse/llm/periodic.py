"""Maximal runs of periodically repeated words, found by block convolution.

A run is a stretch of words with smallest period q (words q apart are identical), of at least ``max(MIN_WORDS, 3 q)``
words, that no neighbouring word extends. At scale L = 8, 16, 32 ... a text is cut into blocks of L words, and each
block is laid over the words that follow it at distances L to 2L - 1 (the first scale 1 to 2L). The sum of squared
differences of word numbers is computed for all distances at once by a number-theoretic transform modulo a prime; where it
is zero the block recurs. A run of period q in [L, 2L) has at least 2L - 1 + q words, so it holds a whole block and the
place q words on, and no run is missed. Zeros are compared word by word (a sum may be a multiple of the prime), joined
when neighbouring blocks agree on the distance, and extended to both sides. Of stretches with equal ends the least distance
is the period.

Blocks holding a word that does not recur within the distances of their scale cannot match and are not convolved. Distances
inside a run found at a smaller scale are multiples of its period and are dropped before they are compared.

Work per text is n log^2 n at most and memory a few arrays of the text's words; Arrow batches are cut into slices of a few
megabytes, and a longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.llm.words import slices

MIN_WORDS = 24
#: A run holds its period this many times.
REPEATS = 3
SMALLEST = 8
# 15 * 2^27 + 1 with generator 31: products stay below 2^62 and transforms reach 2^27 places, periods of 134 million words.
PRIME = 2013265921
GENERATOR = 31
LONGEST = 1 << 27
#: Numbers of one transformed matrix.
CHUNK = 1 << 19

_P = np.uint64(PRIME)


def _rest(x: np.ndarray) -> np.ndarray:
    return x - (x // _P) * _P


def _powers(root: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        step = np.uint64(pow(root, done, PRIME))
        out[done : 2 * done] = _rest(out[: n - done][:done] * step)
        done *= 2
    return out


def _forward(x: np.ndarray) -> np.ndarray:
    """Transform of every row, in bit-reversed order; rows have a power of two places."""
    rows, n = x.shape
    if n > LONGEST:
        raise ValueError(f"a period of more than {LONGEST // 2} words")
    x = x.copy()
    half = n // 2
    while half:
        turn = _powers(pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME), half)
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0].copy(), v[:, :, 1].copy()
        v[:, :, 0] = np.where((s := a + b) >= _P, s - _P, s)
        v[:, :, 1] = _rest((a + _P - b) * turn)
        half //= 2
    return x


def _backward(x: np.ndarray) -> np.ndarray:
    """Undoes ``_forward``."""
    rows, n = x.shape
    x = x.copy()
    half = 1
    while half < n:
        turn = _powers(pow(pow(GENERATOR, PRIME - 2, PRIME), (PRIME - 1) // (2 * half), PRIME), half)
        v = x.reshape(rows, -1, 2, half)
        a, b = v[:, :, 0].copy(), _rest(v[:, :, 1] * turn)
        v[:, :, 0] = np.where((s := a + b) >= _P, s - _P, s)
        v[:, :, 1] = np.where((d := a + _P - b) >= _P, d - _P, d)
        half *= 2
    return _rest(x * np.uint64(pow(n, PRIME - 2, PRIME)))


def mismatch(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Sums of squared differences modulo the prime of every row's block (L numbers) against its window (2L - 1 numbers) at
    the L places where the block fits."""
    rows, size = blocks.shape
    n = 2 * size
    turned = np.zeros((rows, n), dtype=np.uint64)
    turned[:, 0] = blocks[:, 0]
    turned[:, n - size + 1 :] = blocks[:, :0:-1]  # correlation: the block runs backwards
    text = np.zeros((rows, n), dtype=np.uint64)
    text[:, : n - 1] = windows
    cross = _backward(_rest(_forward(turned) * _forward(text)))[:, :size]
    squares = np.zeros((rows, n), dtype=np.uint64)
    np.cumsum(_rest(windows * windows), axis=1, out=squares[:, 1:])
    own = _rest(_rest(blocks * blocks).sum(axis=1))[:, None]
    there = _rest(squares[:, size : 2 * size] - squares[:, :size])
    return _rest(own + there + np.uint64(2) * (_P - cross))


def _gaps(ids: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Words to the next equal word of the same text; a huge number if there is none."""
    order = np.lexsort((np.arange(len(ids)), ids, text))
    out = np.full(len(ids), np.iinfo(np.int64).max, dtype=np.int64)
    a, b = order[:-1], order[1:]
    same = (ids[a] == ids[b]) & (text[a] == text[b])
    out[a[same]] = b[same] - a[same]
    return out


def _seeds(ids: np.ndarray, first: np.ndarray, end: np.ndarray, size: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Blocks (first words, whose texts stop at ``end``) and distances, ``least`` to ``least + size - 1``, with zero mismatch."""
    begins, lags = [], []
    step = max(1, CHUNK // (2 * size))
    inside = np.arange(size)
    for i in range(0, len(first), step):
        b = first[i : i + step]
        blocks = ids[b[:, None] + inside]
        over = np.minimum(b[:, None] + least + np.arange(2 * size - 1), len(ids) - 1)
        zero = mismatch(blocks, ids[over]) == 0
        zero &= b[:, None] + size + least + inside <= end[i : i + step, None]
        row, lag = np.nonzero(zero)
        begins.append(b[row])
        lags.append(lag + least)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *begins]), np.concatenate([none, *lags])


def _equal(ids: np.ndarray, first: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
    out = np.ones(len(first), dtype=bool)
    step, inside = max(1, CHUNK // size), np.arange(size)
    for i in range(0, len(first), step):
        at = first[i : i + step, None] + inside
        out[i : i + step] = (ids[at] == ids[at + lag[i : i + step, None]]).all(axis=1)
    return out


def _reach(ids: np.ndarray, at: np.ndarray, lag: np.ndarray, room: np.ndarray, size: int, way: int) -> np.ndarray:
    """Equal words in a row from ``at`` on (``way`` 1) or before it (-1), at most ``room`` and ``size``."""
    out = np.zeros(len(at), dtype=np.int64)
    step, inside = max(1, CHUNK // size), np.arange(size)
    for i in range(0, len(at), step):
        a, d, free = at[i : i + step, None], lag[i : i + step, None], room[i : i + step, None]
        places = a + inside if way > 0 else a - 1 - inside
        places = np.where(inside < free, places, 0)
        odd = (inside >= free) | (ids[places] != ids[np.where(inside < free, places + d, 0)])
        out[i : i + step] = np.where(odd.any(axis=1), odd.argmax(axis=1), size)
    return out


def find_runs(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period), sorted, of all runs in texts of word numbers laid end to end, cut at ``at``."""
    counts = np.diff(at)
    ids = ids.astype(np.uint64)
    text = np.repeat(np.arange(len(counts)), counts)
    found = np.zeros((0, 3), dtype=np.int64)  # first word, end, period; places in ids
    size = SMALLEST
    longest = int(counts.max(initial=0))
    gaps = _gaps(ids, text) if longest >= MIN_WORDS else None
    while longest >= max(MIN_WORDS, REPEATS * (size if size > SMALLEST else 1)):
        whole = np.where(counts >= max(MIN_WORDS, REPEATS * (size if size > SMALLEST else 1)), counts // size, 0)
        place = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        first = np.repeat(at[:-1], whole) + place * size
        end = np.repeat(at[1:], whole)
        # The farthest of each block's next equal words.
        far = np.zeros(len(first), dtype=np.int64)
        for j in range(size):
            np.maximum(far, gaps[first + j], out=far)
        parts = []
        for least in (1, SMALLEST + 1) if size == SMALLEST else (size,):
            may = (far <= least + size - 1) & (first + size + least <= end)
            parts.append(_seeds(ids, first[may], end[may], size, least))
        begin, lag = (np.concatenate(p) for p in zip(*parts, strict=True))
        begin, lag = _outside(begin, lag, size, found)
        good = _equal(ids, begin, lag, size)
        begin, lag = begin[good], lag[good]
        if len(begin):
            found = np.concatenate([found, _extended(ids, at, text, begin, lag, size)])
            found = _least_periods(found)
        size *= 2
    out = np.column_stack([text[found[:, 0]], found[:, 0] - at[text[found[:, 0]]], found[:, 1] - found[:, 0], found[:, 2]])
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _outside(begin: np.ndarray, lag: np.ndarray, size: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without blocks that lie with their distance in a run whose period divides it."""
    if not len(begin) or not len(found):
        return begin, lag
    order = np.argsort(begin, kind="stable")
    begin, lag = begin[order], lag[order]
    keep = np.ones(len(begin), dtype=bool)
    a = np.searchsorted(begin, found[:, 0])
    b = np.searchsorted(begin, found[:, 1])
    for i in np.flatnonzero(b > a):
        part = slice(a[i], b[i])
        keep[part] &= (begin[part] + size + lag[part] > found[i, 1]) | (lag[part] % found[i, 2] != 0)
    return begin[keep], lag[keep]


def _extended(ids: np.ndarray, at: np.ndarray, text: np.ndarray, begin: np.ndarray, lag: np.ndarray, size: int) -> np.ndarray:
    """Whole stretches of equal words through blocks that recur; those that are long enough, as (first, end, distance)."""
    order = np.lexsort((begin, lag))
    begin, lag = begin[order], lag[order]
    opens = np.ones(len(begin), dtype=bool)
    opens[1:] = (begin[1:] != begin[:-1] + size) | (lag[1:] != lag[:-1]) | (text[begin[1:]] != text[begin[:-1]])
    first = begin[opens]
    last = begin[np.append(np.flatnonzero(opens)[1:] - 1, len(begin) - 1)] + size
    lag = lag[opens]
    lo, hi = at[text[first]], at[text[first] + 1]
    start = first - _reach(ids, first, lag, first - lo, size, -1)
    end = last + _reach(ids, last, lag, hi - last - lag, size, 1) + lag
    long = end - start >= np.maximum(MIN_WORDS, REPEATS * lag)
    return np.column_stack([start[long], end[long], lag[long]])


def _least_periods(found: np.ndarray) -> np.ndarray:
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[new]


def _numbered(texts: list[str | None]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of each text, their numbers end to end and the texts' bounds."""
    # bytes.split() cuts at exactly 0x20 and 0x09-0x0D.
    words = [t.encode().split() if t else [] for t in texts]
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number)) for part in words for w in part]
    at = np.append(0, np.cumsum(np.fromiter(map(len, words), np.int64, len(words))))
    return words, np.array(ids, dtype=np.int64), at


def _collapsed(words: list[bytes], runs: np.ndarray) -> str:
    """Without the words that any run holds after its first period."""
    if not len(runs):
        return b" ".join(words).decode()
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, runs[:, 1] + runs[:, 3], 1)
    np.add.at(steps, runs[:, 1] + runs[:, 2], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist()]).decode()


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with n_words, runs (array of start, length, period by start and period; words are numbered from 0)
    and collapsed (the words outside the repetitions, joined by one space).

    Words are runs of bytes other than space and 0x09-0x0D, compared as they stand. Null and empty texts have 0 words, no
    runs and an empty collapsed text; every row is kept, repeated rows too, and an empty table gives no rows. Columns that
    are not in ``keep`` are left out, and those in it may have any name but the three made here. A text is one task's
    work, whatever its length, in memory of some hundred bytes a word.
    """
    keep = keep or []
    if clash := {"n_words", "runs", "collapsed"} & set(keep):
        raise ValueError(f"{sorted(clash)} are made here and can't be kept")
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(n)):
                part = batch.slice(a, b - a)
                words, ids, at = _numbered(part.column(n).to_pylist())
                runs = find_runs(ids, at)
                cut = np.searchsorted(runs[:, 0], np.arange(len(words) + 1))
                texts = [_collapsed(w, runs[cut[i] : cut[i + 1]]) for i, w in enumerate(words)]
                fields = [pa.array(runs[:, j], pa.int64()) for j in (1, 2, 3)]
                listed = pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_RUN)))
                out = [*part.columns[:n], pa.array(np.diff(at)), listed, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(out, [f"c{i}" for i in range(n + 3)])

    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string"))
    source = source.toDF(*[f"c{i}" for i in range(n)], "text")
    kinds = [f"c{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])]
    made = [f"c{n} long", f"c{n + 1} array<struct<start:long,length:long,period:long>>", f"c{n + 2} string"]
    return source.mapInArrow(run, ", ".join(kinds + made)).toDF(*keep, "n_words", "runs", "collapsed")

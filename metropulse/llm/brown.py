"""Class-based bigram language model with Brown's exchange clustering.

Words are counted over all training texts. The ``COMMON`` commonest words are units of their own, every other word belongs to
the unit of its ending (a hash of the last three bytes). Bigrams of units are counted once and stay distributed, packed by
unit. Exchange begins on the ``HEAD_WORDS`` commonest words, one move at a time over their small matrix; other units take the
class of their ending. Then every unit of the whole table is visited in parallel sweeps: each task knows the class of every
unit and the class bigrams, and proposes the class where the likelihood is highest. A sweep's moves are kept if together they
raise the likelihood, else half of them are tried. Last, every rarer word that occurs ``CLASSED`` times or more takes the
class that its own contexts make likeliest; only words seen less often, or never, keep to their ending's class.

A word's probability is ``p(class | class before) * p(unit | class) * p(word | unit)``, smoothed at each step. The rarer words
of a class are one more unit of it. As context, a rarer word stands for its ending's class.

The units bound what the driver and the tasks hold: a class for each and the moves of a sweep. Rarer words and their counts
meet in shuffles of packed arrays dealt by word.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.llm.words import SLICE_BYTES, mix, slices, text_bytes, word_hashes
from metropulse.operators.staging import settle

HEAD_WORDS = 1024
ENDINGS = 512
CLASSES = 48
COMMON = 1 << 18
SWEEPS = 12
#: Sweeps over all units, and the share of units that still moves below which they end.
WIDE_SWEEPS = 4
SETTLED_SHARE = 0.001
#: A rarer word with so many occurrences has a class of its own choice.
CLASSED = 2
#: Distinct (task, bigram) entries of one bucket of the bigram shuffle, in at most so many buckets.
BUCKET_PAIRS = 1 << 18
MOST_BUCKETS = 4096
#: Entries of a row of the bigram shuffle. Spark hands a task up to 10,000 rows at once and keeps them twice outside its heap.
SHUFFLE_PAIRS = 128
#: Such rows that leave a task, or are taken up by one, in a step.
SHUFFLE_ROWS = 2048
#: Distinct (task, word) entries of one bucket of the counting shuffle.
BUCKET_WORDS = 1 << 20
END = np.uint64(0xE17D)  # the end's own hash; a word has it once in 2^64
LAMBDA = 0.95
FLUSH = 1 << 21
PAIRS_FLUSH = 1 << 20

_COUNTS = "bucket int, words binary, counts binary, endings binary"


def _bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(words ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(buckets)).astype(np.int64)


def _merge(words, counts, endings):
    order = np.argsort(words, kind="stable")
    words, counts, endings = words[order], counts[order], endings[order]
    first = np.flatnonzero(np.append(True, words[1:] != words[:-1])) if len(words) else np.zeros(0, np.int64)
    return words[first], np.add.reduceat(counts, first) if len(first) else counts, endings[first]


def _count_words(buckets: int):
    """Word counts of a task's texts, packed by bucket; merged in the task until ``FLUSH`` distinct words."""

    def packed(held):
        words, counts, endings = held
        to = _bucket(words, buckets)
        order = _stable_order(to)
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        rows = [
            (i, words[o].tobytes(), counts[o].tobytes(), endings[o].astype(np.int16).tobytes())
            for i in range(buckets)
            if len(o := order[cuts[i] : cuts[i + 1]])
        ]
        kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
        arrays = [pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(arrays, ["bucket", "words", "counts", "endings"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for a, b in slices(batch.column(0)):
                words, _, endings = word_hashes(batch.column(0).slice(a, b - a), ENDINGS)
                words, at, counts = np.unique(words, return_index=True, return_counts=True)
                parts.append((words, counts.astype(np.int64), endings[at]))
                parts.append((np.array([END]), np.array([b - a], dtype=np.int64), np.zeros(1, np.int32)))
                size += len(words)
                if size > FLUSH:
                    held = _merge(*(np.concatenate(x) for x in zip(*parts, strict=True)))
                    parts, size = [held], len(held[0])
                    if size > FLUSH // 2:
                        yield packed(held)
                        parts, size = [], 0
        if parts:
            yield packed(_merge(*(np.concatenate(x) for x in zip(*parts, strict=True))))

    return run


def _joined(values, kind) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=kind)


def _unpack(rows: pd.DataFrame):
    return _joined(rows["words"], np.uint64), _joined(rows["counts"], np.int64), _joined(rows["endings"], np.int16)


def _merge_bucket(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    words, counts, endings = _merge(*_unpack(group))
    return pd.DataFrame(
        [(int(key[0]), words.tobytes(), counts.tobytes(), endings.tobytes())], columns=["bucket", "words", "counts", "endings"]
    )


def _spread(rows: DataFrame, least: int) -> DataFrame:
    """(w, c, e) of the words with at least ``least`` occurrences."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            words, counts, endings = _unpack(part)
            keep = counts >= least
            yield pd.DataFrame({"w": words[keep].view(np.int64), "c": counts[keep], "e": endings[keep].astype(np.int64)})

    return rows.mapInPandas(run, "w long, c long, e long")


def _tally(rows: DataFrame) -> DataFrame:
    """(c, k): k words occur c times; counts from 2^20 on are taken down to powers of two."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            counts = _unpack(part)[1]
            high = counts >= 1 << 20
            counts = np.where(high, 1 << np.log2(np.maximum(counts, 1)).astype(np.int64), counts)
            c, k = np.unique(counts, return_counts=True)
            yield pd.DataFrame({"c": c, "k": k})

    return rows.mapInPandas(run, "c long, k long").groupBy("c").agg(F.sum("k").alias("k"))


@dataclass
class Vocabulary:
    """Counts of all words (packed by bucket, on shared storage), their sums, and the commonest words."""

    table: DataFrame
    buckets: int
    tokens: int
    distinct: int
    words: np.ndarray  # sorted, with the end
    counts: np.ndarray
    common: np.ndarray  # sorted, without the end: unit 1 + place
    endings: np.ndarray  # of the common words
    heads: np.ndarray  # places of the first words among the common
    bytes: int


def count_vocabulary(texts: DataFrame, common: int = COMMON) -> Vocabulary:
    """``texts`` has one column, the training texts."""
    size = texts.agg(F.coalesce(F.sum(F.octet_length(texts.columns[0])), F.lit(0))).first()[0]
    buckets = max(8, math.ceil(size / 64 / BUCKET_WORDS))
    counted = texts.mapInArrow(_count_words(buckets), _COUNTS)
    table = settle(counted.groupBy("bucket").applyInPandas(_merge_bucket, _COUNTS), "brown-words").df

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            counts = _unpack(part)[1]
            ends = counts[_unpack(part)[0] == END].sum()
            yield pd.DataFrame({"n": [counts.sum()], "v": [len(counts)], "ends": [ends]})

    n, v, ends = table.mapInPandas(sums, "n long, v long, ends long").agg(F.sum("n"), F.sum("v"), F.sum("ends")).first()
    # The least count that leaves at most ``common`` words: the tally has few rows, for counts of many words are small.
    upper = _tally(table).orderBy(F.desc("c")).limit(common).collect()
    least, held = 1 << 62, 0
    for r in upper:
        if held + r.k > common:
            break
        least, held = r.c, held + r.k
    top = _spread(table, least).toPandas().sort_values(["c", "w"], ascending=[False, True])
    words, counts, endings = top["w"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64), top["e"].to_numpy(np.int64)
    own = words != END
    words, counts, endings = words[own], counts[own], endings[own]
    order = np.argsort(words)
    units, heads = words[order], np.sort(np.argsort(order)[:HEAD_WORDS])
    endings = endings[order]
    if ends:  # the end is always at hand
        words, counts = np.append(words, END), np.append(counts, ends)
    order = np.argsort(words)
    return Vocabulary(table, buckets, n or 0, v or 0, words[order], counts[order], units, endings, heads, size)


def _find(sorted_: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_):
        return np.zeros(len(x), np.int64), np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
    return at, sorted_[at] == x


def units_of(words: np.ndarray, endings: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Unit 0 is the end, then the common words, then the endings. Different words are looked up once, in order."""
    different, which = np.unique(words, return_inverse=True)
    at, hit = _find(common, different)
    return np.where(hit[which], 1 + at[which], 1 + len(common) + endings)


def _stable_order(*keys: np.ndarray) -> np.ndarray:
    """The order by the last key, ties by the keys before it, then by place; keys are from 0 to 2^31. Short numbers are sorted by
    their digits, without comparisons."""
    order = np.arange(len(keys[0]))
    for key in keys:
        for shift in range(0, max(int(key.max(initial=0)).bit_length(), 1), 16):
            digit = (key >> shift).astype(np.uint16)
            order = order[np.argsort(digit[order], kind="stable")]
    return order


def _unit_lines(column: pa.Array, common: np.ndarray):
    """Units of all tokens with an end after every text; the token before a text's first is the end. Also the words, an
    end's hash at each end, and the offsets of the texts."""
    words, at, endings = word_hashes(column, ENDINGS)
    rows = len(at) - 1
    place = np.arange(len(words)) + np.repeat(np.arange(rows), np.diff(at))
    units = np.zeros(len(words) + rows, dtype=np.int64)
    units[place] = units_of(words, endings, common)
    line = np.full(len(units), END, dtype=np.uint64)
    line[place] = words
    before = np.append(0, units[:-1]) if len(units) else units
    return units, before, line, at + np.arange(rows + 1)


_FLAT = "side boolean, bucket int, a binary, b binary, n binary"
_PAIRS = "bucket int, a binary, a_runs binary, b binary, n binary, q binary, q_runs binary, p binary, m binary"
#: Bigrams of a row of the bucket table, unless one unit has more.
ROW_PAIRS = 1 << 17


def _add_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def _dealt(keys: np.ndarray, n: np.ndarray, span: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Entries for the shuffle, once by the bucket of their first unit and once by that of their second, ``SHUFFLE_PAIRS`` to a row."""
    first, second, times = (keys // span).astype(np.int32), (keys % span).astype(np.int32), n.astype(np.int32)
    for side, unit in ((True, first), (False, second)):
        to = _bucket(unit.astype(np.uint64), buckets)
        # By the bucket's own unit, which packs better.
        order = _stable_order(unit, to)
        cuts = np.searchsorted(to[order], np.arange(buckets + 1))
        rows = -(-np.diff(cuts) // SHUFFLE_PAIRS)
        bucket = np.repeat(np.arange(buckets, dtype=np.int32), rows)
        place = np.arange(len(bucket)) - np.repeat(np.cumsum(rows) - rows, rows)
        begins = np.append(cuts[bucket] + place * SHUFFLE_PAIRS, len(order))
        for x in range(0, len(bucket), SHUFFLE_ROWS):
            some = bucket[x : x + SHUFFLE_ROWS]
            at = begins[x : x + len(some) + 1]
            ends = pa.py_buffer(((at - at[0]) * 4).astype(np.int32))
            here = order[at[0] : at[-1]]
            packed = [pa.Array.from_buffers(pa.binary(), len(some), [None, ends, pa.py_buffer(v[here])]) for v in (first, second, times)]
            arrays = [pa.array(np.full(len(some), side)), pa.array(some), *packed]
            yield pa.RecordBatch.from_arrays(arrays, ["side", "bucket", "a", "b", "n"])


def count_pairs(texts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Unit bigrams over all training texts. A bucket's row holds the bigrams (a, b, n) whose first unit is dealt to it and
    those (p, q, m) whose second unit is. Tasks add up before the shuffle, which takes every bigram to both its buckets. There a
    bucket's entries are added up as they stream in, so that a task holds different bigrams of one bucket's units only, however
    often they came."""
    span = 1 + len(vocabulary.common) + ENDINGS
    buckets = min(max(8, math.ceil(vocabulary.bytes / 16 / BUCKET_PAIRS)), MOST_BUCKETS)
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary.common)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        parts, size = [], 0
        for batch in batches:
            for a, b in slices(batch.column(0), SLICE_BYTES // 2):
                now, before, _, _ = _unit_lines(batch.column(0).slice(a, b - a), common)
                parts.append(np.unique(before * span + now, return_counts=True))
                size += len(parts[-1][0])
                if size > PAIRS_FLUSH:
                    held = _add_up(parts)
                    parts, size = [held], len(held[0])
                    if size > PAIRS_FLUSH // 2:
                        yield from _dealt(*held, span, buckets)
                        parts, size = [], 0
        if parts:
            yield from _dealt(*_add_up(parts), span, buckets)

    def written(bucket: int, held: dict[bool, list]) -> Iterator[pa.RecordBatch]:
        sides = []
        for side in (True, False):
            keys, n = _add_up(held[side]) if held[side] else (np.zeros(0, np.int64), np.zeros(0, np.int64))
            sides.append((keys // span, keys % span, n))
        units, entries = np.unique(np.concatenate([side[0] for side in sides]), return_counts=True)
        cuts = np.append(np.flatnonzero(np.diff(np.cumsum(entries) // ROW_PAIRS, prepend=-1)), len(units))
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            row = []
            for unit, other, n in sides:
                at = slice(*np.searchsorted(unit, (units[x], units[y - 1] + 1)))
                own, runs = np.unique(unit[at], return_counts=True)
                row += [own.astype(np.int32).tobytes(), runs.astype(np.int32).tobytes(), other[at].astype(np.int32).tobytes(), _narrow(n[at])]
            arrays = [pa.array([bucket], pa.int32()), *(pa.array([x], pa.binary()) for x in row)]
            yield pa.RecordBatch.from_arrays(arrays, [f.split()[0] for f in _PAIRS.split(", ")])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, {True: [], False: []}, 0
        for batch in batches:
            sides, to = batch.column("side").to_numpy(zero_copy_only=False), batch.column("bucket").to_numpy()
            new = np.flatnonzero((to[1:] != to[:-1]) | (sides[1:] != sides[:-1])) + 1
            # Rows of one side of one bucket, a step's at most; their numbers lie one after the other.
            cuts = np.union1d(np.append(new, len(to)), np.arange(0, len(to), SHUFFLE_ROWS))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                if to[x] != now:
                    if now is not None:
                        yield from written(now, held)
                    now, held, size = int(to[x]), {True: [], False: []}, 0
                a, b, n = (text_bytes(batch.column(c).slice(x, y - x))[0].view(np.int32).astype(np.int64) for c in ("a", "b", "n"))
                held[bool(sides[x])].append((a * span + b if sides[x] else b * span + a, n))
                size += len(a)
                if size > PAIRS_FLUSH:
                    held = {k: [_add_up(parts)] if parts else [] for k, parts in held.items()}
                    # The next time after as many more as are held.
                    size = -sum(len(parts[0][0]) for parts in held.values() if parts)
        if now is not None:
            yield from written(now, held)

    dealt_out = texts.mapInArrow(gather, _FLAT).repartition("bucket").sortWithinPartitions("bucket", "side")
    return settle(dealt_out.mapInArrow(whole, _PAIRS), "brown-pairs").df


def _narrow(n: np.ndarray) -> bytes:
    """Counts in the narrowest numbers that hold them all."""
    return n.astype(np.min_scalar_type(int(n.max(initial=0)))).tobytes()


def _entries(units, runs, others, times) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    others = np.frombuffer(others, np.int32)
    kind = f"u{max(len(times) // max(len(others), 1), 1)}"
    unit = np.repeat(np.frombuffer(units, np.int32), np.frombuffer(runs, np.int32))
    return unit, others, np.frombuffer(times, kind).astype(np.int64)


def _firsts(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, n) of a row, by a."""
    return _entries(row["a"], row["a_runs"], row["b"], row["n"])


def _seconds(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(p, q, m) of a row, by q."""
    q, p, m = _entries(row["q"], row["q_runs"], row["p"], row["m"])
    return p, q, m


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows of binary columns as buffers, without a copy."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: memoryview(batch.column(name)[i].as_buffer()) for name in batch.schema.names}


def _cells(rows: DataFrame, size: int) -> np.ndarray:
    """The sums of a column ``n`` by ``cell``: at most ``size`` rows reach the driver, after partial sums."""
    out = np.zeros(size, dtype=np.int64)
    for r in rows.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out


def _grouped(pairs: DataFrame, group: np.ndarray, groups: int) -> np.ndarray:
    """Bigrams of groups of units, ``group`` naming each unit's: a groups x groups matrix."""
    shared = pairs.sparkSession.sparkContext.broadcast(group)
    width = 64 * groups  # cells of a block of rows

    def packed(block: int, sums: np.ndarray) -> list:
        at = np.flatnonzero(sums)
        return [block, at.astype(np.int32).tobytes(), sums[at].tobytes()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = shared.value
        sums = np.zeros(groups * groups, dtype=np.int64)
        for row in _rows(batches):
            a, b, n = _firsts(row)
            np.add.at(sums, group[a] * groups + group[b], n)
        for start in range(0, len(sums), width):
            if sums[start : start + width].any():
                row = pd.DataFrame([packed(start // width, sums[start : start + width])], columns=["block", "at", "n"])
                kinds = pa.schema([("block", pa.int32()), ("at", pa.binary()), ("n", pa.binary())])
                yield pa.RecordBatch.from_pandas(row, kinds, preserve_index=False)

    def add(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for part in parts:
            for r in part.itertuples(index=False):
                total = totals.setdefault(int(r.block), np.zeros(width, dtype=np.int64))
                total[np.frombuffer(r.at, np.int32)] += np.frombuffer(r.n, np.int64)
        for block, total in totals.items():
            yield pd.DataFrame([packed(block, total)], columns=["block", "at", "n"])

    schema = "block int, at binary, n binary"
    # Added up as rows stream through, in two steps, so no task holds all tasks' rows.
    some = pairs.select("a", "a_runs", "b", "n").mapInArrow(run, schema)
    some = some.repartition(16, "block", F.pmod(F.xxhash64("n"), F.lit(8))).mapInPandas(add, schema)
    matrix = np.zeros(groups * groups, dtype=np.int64)
    for r in some.repartition(4, "block").mapInPandas(add, schema).collect():
        matrix[r.block * width + np.frombuffer(r.at, np.int32)] += np.frombuffer(r.n, np.int64)
    return matrix.reshape(groups, groups)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(table: np.ndarray) -> float:
    """The part of the log-likelihood that depends on the classes."""
    t = table.astype(np.float64)
    return float(_xlogx(t).sum() - _xlogx(t.sum(axis=0)).sum() - _xlogx(t.sum(axis=1)).sum())


def move_scores(right: np.ndarray, left: np.ndarray, own: np.ndarray, table: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each unit and class, the likelihood with the unit in that class, less the likelihood without the unit.

    ``right`` and ``left`` are the unit's bigrams with each class after and before it, ``own`` those with itself, ``table`` the
    class bigrams with the unit still in its class ``of``. The end's class 0 takes no other unit.
    """
    i, k = np.arange(len(of)), np.arange(len(table))
    r, l = right.copy(), left.copy()
    r[i, of] -= own
    l[i, of] -= own
    t = np.repeat(table[None].astype(np.float64), len(of), axis=0)
    t[i, of, :] -= r
    t[i, :, of] -= l
    t[i, of, of] -= own
    base = _xlogx(t)
    score = (_xlogx(t + r[:, None, :]) - base).sum(axis=2) + (_xlogx(t + l[:, :, None]) - base).sum(axis=1)
    cross, s = t[:, k, k], own[:, None]
    score += _xlogx(cross + r + l + s) - _xlogx(cross + r) - _xlogx(cross + l) + _xlogx(cross)
    # Wherever the unit goes, the classes before it keep those bigrams in their rows, and the classes after it in their columns.
    rows, cols = t.sum(axis=2) + l, t.sum(axis=1) + r
    score -= _xlogx(rows + r.sum(axis=1, keepdims=True) + s) - _xlogx(rows)
    score -= _xlogx(cols + l.sum(axis=1, keepdims=True) + s) - _xlogx(cols)
    score[:, 0] = -np.inf
    return score


def _proposals(pairs: DataFrame, of: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units that would do better in another class, and that class. At most one move per unit reaches the driver."""
    shared = pairs.sparkSession.sparkContext.broadcast((of, table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = shared.value
        k = len(table)
        for row in _rows(batches):
            a, b, n = _firsts(row)
            p, q, m = _seconds(row)
            mine = np.union1d(a, q)
            mine = mine[mine != 0]
            moved, to = [], []
            for at in range(0, len(mine), 256):
                some = mine[at : at + 256]
                # Both lists are in the order of the row's units.
                x, y = (slice(*np.searchsorted(c, (some[0], some[-1] + 1))) for c in (a, q))
                size = len(some) * k
                right = np.bincount(np.searchsorted(some, a[x]) * k + of[b[x]], n[x], size).reshape(-1, k)
                left = np.bincount(np.searchsorted(some, q[y]) * k + of[p[y]], m[y], size).reshape(-1, k)
                twice = a[x] == b[x]
                own = np.bincount(np.searchsorted(some, a[x][twice]), n[x][twice], len(some))
                old = of[some]
                score = move_scores(right, left, own, table, old)
                best = np.argmax(score, axis=1)
                each = np.arange(len(some))
                go = score[each, best] > score[each, old] + 1e-6
                moved.append(some[go])
                to.append(best[go])
            if moved:
                out = [np.concatenate(moved).astype(np.int32).tobytes(), np.concatenate(to).astype(np.int16).tobytes()]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in out], ["u", "c"])

    found = pairs.drop("bucket").mapInArrow(run, "u binary, c binary").toPandas()
    return _joined(found["u"], np.int32), _joined(found["c"], np.int16).astype(np.int64)


def sweep(pairs: DataFrame, of: np.ndarray, classes: int = CLASSES, sweeps: int = WIDE_SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """Exchange over all units in parallel: their classes and the class bigrams. The likelihood never falls."""
    table = _grouped(pairs, of, classes)
    for _ in range(sweeps):
        units, to = _proposals(pairs, of, table)
        # Units that move together change each other's contexts; where that costs more than it brings, half of them move.
        turn = mix(units.astype(np.uint64) + np.uint64(1))
        share = 0
        while len(units) > SETTLED_SHARE * len(of) or (share == 0 and len(units)):
            trial = of.copy()
            trial[units] = to
            after = _grouped(pairs, trial, classes)
            if likelihood(after) > likelihood(table):
                of, table = trial, after
                break
            keep = (turn >> np.uint64(share)) & np.uint64(1) == 0
            units, to, turn, share = units[keep], to[keep], turn[keep], share + 1
        else:
            break
    return of, table


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit. Unit 0, the end, is class 0 for good. Units begin in frequency order in turn; each sweep visits
    them by frequency and moves one to the class where the bigram likelihood is highest, if that is higher."""
    units = len(bigrams)
    n = bigrams.astype(np.float64)
    mass = n.sum(axis=1) + n.sum(axis=0)
    order = np.argsort(-mass, kind="stable")
    order = order[order != 0]
    of = np.zeros(units, dtype=np.int64)
    of[order] = 1 + np.arange(len(order)) % (classes - 1)
    member = np.zeros((units, classes))
    member[np.arange(units), of] = 1
    right, left = n @ member, n.T @ member  # to classes, from classes
    table = member.T @ right

    def gain(x: np.ndarray) -> np.ndarray:
        return x * np.log(np.maximum(x, 1e-300))

    for _ in range(sweeps):
        moved = 0
        for u in order.tolist():
            if not mass[u]:
                continue
            old = of[u]
            r, l, self_ = right[u].copy(), left[u].copy(), n[u, u]
            r[old] -= self_
            l[old] -= self_
            table[old] -= r
            table[:, old] -= l
            table[old, old] -= self_
            rows, cols = table.sum(axis=1) + l, table.sum(axis=0) + r
            # What joining class k adds: its row and column, the crossing cell once, less the margins.
            row_gain = (gain(table + r) - gain(table)).sum(axis=1)
            col_gain = (gain(table + l[:, None]) - gain(table)).sum(axis=0)
            cross = np.diag(table)
            both = gain(cross + r + l + self_) - gain(cross) - (gain(cross + r) - gain(cross)) - (gain(cross + l) - gain(cross))
            out, into = r.sum() + self_, l.sum() + self_
            margin = gain(rows + out) - gain(rows) + gain(cols + into) - gain(cols)
            score = row_gain + col_gain + both - margin
            score[0] = -np.inf
            new = int(np.argmax(score))
            if score[new] <= score[old] + 1e-9:
                new = old
            table[new] += r
            table[:, new] += l
            table[new, new] += self_
            if new != old:
                moved += 1
                of[u] = new
                right[:, old] -= n[:, u]
                right[:, new] += n[:, u]
                left[:, old] -= n[u]
                left[:, new] += n[u]
        if moved < 0.001 * len(order):
            break
    return of


@dataclass
class BrownModel:
    vocabulary: Vocabulary
    table: DataFrame  # the vocabulary's buckets with a class for each rarer word, -1 where it keeps to its ending
    classes: np.ndarray
    step: np.ndarray  # log10 p(class | class before)
    inside: np.ndarray  # log10 p(unit | class of the unit)
    ending_down: np.ndarray  # log10 of what an ending's counts are divided by
    rarer: np.ndarray  # log10 p(rarer word | class) less log10 of its count


_CLASSED = f"{_COUNTS}, classes binary, cells binary"


def _rare_contexts(texts: DataFrame, common: np.ndarray, of: np.ndarray, buckets: int) -> DataFrame:
    """(bucket, words, before, times): the words that are no units, by the class before them, added up in slices."""
    shared = texts.sparkSession.sparkContext.broadcast((common, of))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, of = shared.value
        for batch in batches:
            for a, b in slices(batch.column(0)):
                units, before, line, _ = _unit_lines(batch.column(0).slice(a, b - a), common)
                rare = units > len(common)
                words, classes, times = _distinct(line[rare], of[before[rare]])
                to = _bucket(words, buckets)
                order = _stable_order(to)
                cuts = np.searchsorted(to[order], np.arange(buckets + 1))
                at = np.flatnonzero(np.diff(cuts)).tolist()
                dealt = [
                    pa.array([x[order[cuts[i] : cuts[i + 1]]].tobytes() for i in at], pa.binary())
                    for x in (words, classes.astype(np.int16), times.astype(np.int32))
                ]
                if at:
                    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *dealt], ["bucket", "words", "before", "times"])

    return texts.mapInArrow(run, "bucket int, words binary, before binary, times binary")


def _distinct(words: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((classes, words))
    words, classes = words[order], classes[order]
    new = np.append(True, (words[1:] != words[:-1]) | (classes[1:] != classes[:-1])) if len(words) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    return words[first], classes[first], np.diff(np.append(first, len(words)))


def class_rare_words(
    texts: DataFrame, vocabulary: Vocabulary, of: np.ndarray, given: np.ndarray, after: np.ndarray
) -> tuple[DataFrame, np.ndarray]:
    """A class for each word that is no unit and occurs ``CLASSED`` times or more: the one that makes its occurrences after the
    classes before them likeliest. Also the change of the class bigrams from its ending's class to its own."""
    common, k = vocabulary.common, len(given)
    ending_class = of[1 + len(common) :]
    with np.errstate(divide="ignore"):
        worth = np.log(given) - np.log(np.maximum(after, 1))
    worth[:, 0] = -np.inf

    def choose(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        known, counts, endings = _unpack(right)
        classes, cells = np.full(len(known), -1, np.int16), np.zeros(k * k, np.int64)
        words, before, times = _joined(left["words"], np.uint64), _joined(left["before"], np.int16), _joined(left["times"], np.int32)
        at, _ = _find(known, words)
        order = np.argsort(at, kind="stable")
        at, before, times = at[order], before[order], times[order]
        for start in range(0, len(known), 1 << 15):  # so many words' contexts at once
            x = slice(*np.searchsorted(at, (start, start + (1 << 15))))
            size = min(1 << 15, len(known) - start)
            contexts = np.bincount((at[x] - start) * k + before[x], times[x], size * k).reshape(size, k)
            mine = np.flatnonzero((counts[start : start + size] >= CLASSED) & (contexts.sum(axis=1) > 0))
            if len(mine):
                own = contexts[mine]
                score = own @ np.where(np.isfinite(worth), worth, 0.0)
                score[:, 0] = -np.inf
                best = np.argmax(score, axis=1)
                classes[start + mine] = best
                old = ending_class[endings[start + mine]]
                rows = np.arange(k)[None] * k
                cells += np.bincount((rows + best[:, None]).ravel(), own.ravel(), k * k).astype(np.int64)
                cells -= np.bincount((rows + old[:, None]).ravel(), own.ravel(), k * k).astype(np.int64)
        row = (int(key[0]), known.tobytes(), counts.tobytes(), endings.tobytes(), classes.tobytes(), cells.tobytes())
        return pd.DataFrame([row], columns=[f.split()[0] for f in _CLASSED.split(", ")])

    found = _rare_contexts(texts, common, of, vocabulary.buckets).groupBy("bucket")
    table = settle(found.cogroup(vocabulary.table.groupBy("bucket")).applyInPandas(choose, _CLASSED), "brown-classed").df

    def changes(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros(k * k, np.int64)
        for part in parts:
            for cells in part["cells"]:
                sums += np.frombuffer(cells, np.int64)
        yield pd.DataFrame({"cell": np.arange(k * k), "n": sums})

    moved = _cells(table.select("cells").mapInPandas(changes, "cell long, n long"), k * k)
    return table.drop("cells"), moved.reshape(k, k)


def _steps(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smoothed p(class | class before), and how often each class came."""
    after = pairs.sum(axis=0)
    alone = (after + 1) / (after.sum() + len(pairs))
    given = (pairs + 0.1 * alone) / (pairs.sum(axis=1, keepdims=True) + 0.1)
    return LAMBDA * given + (1 - LAMBDA) * alone, after


def fit(texts: DataFrame, common: int = COMMON) -> BrownModel:
    """Learn from the one text column of ``texts``; an empty table gives a model of unknown words only. ``common`` bounds the
    words that are units, and with them what the driver holds; all others are classed where they are counted."""
    texts = texts.select(F.coalesce(F.col(texts.columns[0]).cast("string"), F.lit("")).alias("text"))
    known = count_vocabulary(texts, common)
    units, heads = 1 + len(known.common) + ENDINGS, known.heads
    pairs = count_pairs(texts, known)
    # The first classes: heads one by one, the others by their endings.
    first = np.append(0, np.append(1 + len(heads) + known.endings, 1 + len(heads) + np.arange(ENDINGS)))
    first[1 + heads] = 1 + np.arange(len(heads))
    of = exchange(_grouped(pairs, first, 1 + len(heads) + ENDINGS))[first]
    of, bigrams = sweep(pairs, of)
    steps, after = _steps(bigrams)
    table, moved = class_rare_words(texts, known, of, steps, after)
    steps, after = _steps(bigrams + moved)

    # Tokens of each ending's words that have no class, their number, and tokens of each class's rarer words.
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(known.common)

    def sums(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = shared.value
        n = np.zeros(2 * ENDINGS + CLASSES, np.int64)
        for part in parts:
            words, counts, endings = _unpack(part)
            classes = _joined(part["classes"], np.int16)
            rest = ~_find(common, words)[1] & (words != END)
            free, own = rest & (classes < 0), rest & (classes >= 0)
            n[:ENDINGS] += np.bincount(endings[free], counts[free], ENDINGS).astype(np.int64)
            n[ENDINGS : 2 * ENDINGS] += np.bincount(endings[free], minlength=ENDINGS)
            n[2 * ENDINGS :] += np.bincount(classes[own], counts[own], CLASSES).astype(np.int64)
        yield pd.DataFrame({"cell": np.arange(len(n)), "n": n})

    found = _cells(table.mapInPandas(sums, "cell long, n long"), 2 * ENDINGS + CLASSES).astype(np.float64)
    tokens, distinct, rarer = found[:ENDINGS], found[ENDINGS : 2 * ENDINGS], found[2 * ENDINGS :]
    times = np.zeros(units)
    place, _ = _find(known.words, known.common)
    times[1 : 1 + len(known.common)] = known.counts[place] if len(known.common) else 0
    end, has_end = _find(known.words, np.array([END]))
    times[0] = known.counts[end[0]] if has_end[0] else 0
    times[1 + len(known.common) :] = tokens
    within = np.bincount(of, times + 1, CLASSES) + rarer
    inside = np.log10((times + 1) / within[of])
    # p(word | class) of a rarer word is its count over the tokens of the class.
    return BrownModel(known, table, of, np.log10(steps), inside, np.log10(tokens + distinct + 1), -np.log10(np.maximum(within, 1)))


_PARTS = "part int, key long, held_out boolean, h long, rows long, n_tokens long, known long, base double, score double, words binary, times binary, who binary, spread binary, before binary"


def score_texts(docs: DataFrame, model: BrownModel, id_col: str, text_col: str, held_out: Column) -> DataFrame:
    """(``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    A null text is empty: one end. A null id stays null. Rows that share id and text are scored as one and returned as often
    as they came.
    """
    vocabulary = model.vocabulary
    spark = docs.sparkSession
    common, buckets = vocabulary.common, vocabulary.buckets
    tokens, distinct = vocabulary.tokens, vocabulary.distinct
    down = math.log10(tokens + distinct + 1)
    of, step, inside, unit_down = model.classes, model.step, model.inside, model.ending_down
    # By unit, the end's first: whether its word was learned from and what the base score has for it. An ending tells nothing of a word.
    at_hand = _find(vocabulary.words, np.append(END, common))
    learned = np.append(at_hand[1], np.zeros(ENDINGS, bool))
    counts = vocabulary.counts[at_hand[0]] if len(vocabulary.counts) else np.zeros(1 + len(common))
    logs = np.where(learned, np.log10(np.append(counts, np.zeros(ENDINGS)) + 1.0), 0.0) - down
    shared = spark.sparkContext.broadcast((common, learned, logs, of, step, inside, unit_down))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, learned, logs, of, step, inside, unit_down = shared.value
        for batch in batches:
            for a, b in slices(batch.column(2)):
                part = batch.slice(a, b - a)
                units, before, line, at = _unit_lines(part.column(2), common)
                row = np.repeat(np.arange(len(part)), np.diff(at))
                ending = units - 1 - len(common)
                tail = ending >= 0
                # A word that is no unit counts as never seen until its bucket says more.
                part_score = step[of[before], of[units]] + inside[units]
                part_score[tail] -= unit_down[ending[tail]]
                sums = [np.add.reduceat(x, at[:-1]) for x in (learned[units].astype(np.int64), logs[units], part_score)]
                rare = np.flatnonzero(tail)
                key, who, ahead = line[rare], row[rare], of[before[rare]]
                order = np.lexsort((ahead, key, who))
                key, who, ahead = key[order], who[order], ahead[order]
                new = (key[1:] != key[:-1]) | (who[1:] != who[:-1]) | (ahead[1:] != ahead[:-1])
                first = np.flatnonzero(np.append(True, new)) if len(key) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(key)))
                key, who, ahead = key[first], who[first], ahead[first]
                to = _bucket(key, buckets)
                ids, h = part.column(0), np.asarray(part.column(1))
                order = _stable_order(to)
                cuts = np.searchsorted(to[order], np.arange(buckets + 1))
                n = len(part)
                none = pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, -1, np.int32)),
                        ids,
                        part.column(3),
                        part.column(1),
                        pa.array(np.ones(n, np.int64)),
                        pa.array(np.diff(at)),
                        *(pa.array(x) for x in sums),
                        *[none] * 5,
                    ],
                    [f.split()[0] for f in _PARTS.split(", ")],
                )
                out = []
                filled = np.asarray(ids.fill_null(0))
                nulls = np.asarray(ids.is_null())
                for i in range(buckets):
                    o = order[cuts[i] : cuts[i + 1]]
                    if not len(o):
                        continue
                    used, small = np.unique(who[o], return_inverse=True)
                    keys = np.stack([filled[used], h[used], nulls[used].astype(np.int64)])
                    out.append((i, key[o].tobytes(), times[o].astype(np.int32).tobytes(), small.astype(np.int32).tobytes(), keys.tobytes(), ahead[o].astype(np.int16).tobytes()))
                if out:
                    m = len(out)
                    blank = [pa.nulls(m, t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                    columns = [pa.array([x[j] for x in out], pa.binary()) for j in range(1, 6)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in out], pa.int32()), *blank, *columns], [f.split()[0] for f in _PARTS.split(", ")]
                    )

    rarer = model.rarer
    ending_class, ending_inside = of[1 + len(common) :], inside[1 + len(common) :]

    def rare_words(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """What a bucket's rarer words add per document; one slice's rows at a time."""
        known, counts, endings = _unpack(right)
        classes = _joined(right["classes"], np.int16)
        out = []
        for r in left.itertuples(index=False):
            words, times, ahead = np.frombuffer(r.words, np.uint64), np.frombuffer(r.times, np.int32), np.frombuffer(r.before, np.int16)
            who, docs_ = np.frombuffer(r.who, np.int32), np.frombuffer(r.spread, np.int64).reshape(3, -1)
            at, hit = _find(known, words)
            words, times, ahead, who, at = (x[hit] for x in (words, times, ahead, who, at))
            n = docs_.shape[1]
            found = np.bincount(who, times, n).astype(np.int64)
            some = np.flatnonzero(found)
            if not len(some):
                continue
            count, e, c = counts[at], endings[at], classes[at]
            more = np.log10(count + 1.0)
            own = step[ahead, c] + rarer[c] + np.log10(count)
            unseen = step[ahead, ending_class[e]] + ending_inside[e] - unit_down[e]
            score = np.where(c >= 0, own - unseen, more)
            ids = pd.array(docs_[0][some], dtype="Int64")
            ids[docs_[2][some] > 0] = pd.NA
            sums = {name: np.bincount(who, x * times, n)[some] for name, x in (("log", more), ("own", score))}
            out.append(pd.DataFrame({"key": ids, "h": docs_[1][some], "known": found[some], **sums}))
        return pd.concat(out) if out else pd.DataFrame({"key": [], "h": [], "known": [], "log": [], "own": []})

    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("key"), F.xxhash64(text).alias("h"), text.alias("text"), held_out.alias("held_out")
    )
    parts = settle(source.mapInArrow(local, _PARTS), "brown-parts").df
    rare = parts.where("part >= 0").select("part", "words", "times", "who", "spread", "before").groupBy("part")
    rare = rare.cogroup(model.table.groupBy("bucket")).applyInPandas(rare_words, "key long, h long, known long, log double, own double")
    mine = parts.where("part < 0").select("key", "h", "held_out", "rows", "n_tokens", "known", "base", "score")
    zero = F.lit(0).cast("long")
    late = rare.select("key", "h", F.lit(None).cast("boolean").alias("held_out"), zero.alias("rows"), zero.alias("n_tokens"), "known", F.col("log").alias("base"), F.col("own").alias("score"))
    summed = mine.union(late).groupBy("key", "h").agg(
        F.max("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("rows", "n_tokens", "known", "base", "score")]
    )
    one = F.col("rows")
    return summed.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), one))).select(
        F.col("key").alias(id_col),
        "held_out",
        (F.col("n_tokens") / one).cast("long").alias("n_tokens"),
        (F.col("known") / one).cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") / one).alias("base_score"),
        (F.col("score") / one).alias("score"),
    )

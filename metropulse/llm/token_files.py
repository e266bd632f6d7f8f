"""Files of token ids as directly addressable codes.

An id is split into chunks of fixed bit widths, lowest bits first. Level 0 holds the lowest chunk of every id and a bitmap
that says whether a higher chunk follows; level 1 the next chunk of those that go on, with its own bitmap, and so on. An id
at place i is read by taking its chunk of level 0 and, while the bitmap is set, going to place rank(i) of the next level. Rank
directories make that a matter of three small reads: ones before each 65,536 bits, ones since then before each 512 bits, and
the bits in between. Nothing else has to be decoded, so any token of a file costs the same.

Layout, little-endian: header ``<4sHHQQ`` (magic, version, levels, documents, ids); for each level ``<BQ`` (width of its
chunks in bits, number of chunks); n_docs document ids (int64) and one byte each that is 1 for a null id; n_docs + 1 places of
the documents' first ids (uint64); then per level the chunks (bit-packed, most significant bit first), the bitmap (same order;
none at the last level), the counts per 65,536 bits (uint64) and per 512 bits (uint16); last the CRC-32 of all before
(uint32). Parts follow each other without gaps, so the header tells where each is.

The widths are chosen per file for the fewest bits from the histogram of its ids' lengths.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metropulse.llm.words import slices

MAGIC, VERSION = b"DACS", 1
HEAD, LEVEL = struct.Struct("<4sHHQQ"), struct.Struct("<BQ")
SUPER, BLOCK = 1 << 16, 512
ID_BITS, WIDEST = 32, 8
#: Bits of bitmap and directory a chunk; the time for another level's rank counts as one more.
PLACES = 2 + 16 / BLOCK + 64 / SUPER
#: Ids after which a file is closed. A document is never split, so a longer one is a file of its own.
FILE_IDS = 8 << 20
#: Numbers packed or unpacked at once.
STEP = 1 << 20
#: Signs of a text that are encoded at once.
STRETCH = 4 << 20
#: Words and ids that a worker keeps.
CACHED_WORDS = 600_000
CACHED_IDS = 8_000_000
JOINED = 64
END_ID = 0

_MANIFEST = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_bytes", pa.int64())]
)

class BadFile(ValueError):
    pass


# --- codes -------------------------------------------------------------------------------------------------------------


def best_widths(lengths: np.ndarray) -> list[int]:
    """Chunk widths, lowest first, of at most a byte with the fewest bits for a histogram of bit lengths (index 1 and up): each
    chunk but the last level's costs its width and ``PLACES`` bits of bitmap, directory and time."""
    top = int(np.flatnonzero(lengths)[-1]) if lengths.any() else 1
    above = np.append(np.cumsum(lengths[::-1])[::-1], 0)  # above[b]: ids of at least b bits
    cost, choice = [0.0] * (top + 1), [0] * (top + 1)
    for low in range(top - 1, -1, -1):  # bits from low on are still to be held
        holders = float(above[low + 1] if low else above[0])
        best = []
        for width in range(1, min(WIDEST, top - low) + 1):
            last = low + width == top
            best.append((holders * (width + (0 if last else PLACES)) + cost[low + width], -width))
        cost[low], least = min(best)
        choice[low] = -least
    widths, low = [], 0
    while low < top:
        widths.append(choice[low])
        low += choice[low]
    return widths


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Eight values of at most a byte become ``width`` bytes."""
    out = []
    for i in range(0, len(values), STEP):
        part = values[i : i + STEP]
        eights = np.zeros(-(-len(part) // 8) * 8, dtype=np.uint64)
        eights[: len(part)] = part
        word = np.zeros(len(eights) // 8, dtype=">u8")
        for k, column in enumerate(eights.reshape(-1, 8).T):
            word |= column << np.uint64((7 - k) * width)
        out.append(word.view(np.uint8).reshape(-1, 8)[:, 8 - width :].tobytes())
    return b"".join(out)[: (len(values) * width + 7) // 8]


def unpack_bits(data: np.ndarray, width: int, skip: int, n: int) -> np.ndarray:
    """``n`` values after the first ``skip`` of the packed bytes."""
    out = np.empty(-(-(skip + n) // 8) * 8, dtype=np.uint32)
    ones = np.uint64((1 << width) - 1)
    for i in range(0, len(out), STEP):
        part = data[i // 8 * width : (i + STEP) // 8 * width]
        eights = min(STEP, len(out) - i) // 8
        word = np.zeros((eights, 8), dtype=np.uint8)
        word[:, 8 - width :] = np.append(part, np.zeros(eights * width - len(part), dtype=np.uint8)).reshape(eights, width)
        word = word.view(">u8").astype(np.uint64)[:, 0]
        for k in range(8):
            out[i + k : i + 8 * eights : 8] = (word >> np.uint64((7 - k) * width)) & ones
    return out[skip : skip + n]


def _sizes(width: int, n: int, last: bool) -> list[int]:
    """Bytes of a level's chunks, bitmap and two directories."""
    chunks = (n * width + 7) // 8
    return [chunks, 0, 0, 0] if last else [chunks, (n + 7) // 8, -(-n // SUPER) * 8, -(-n // BLOCK) * 2]


def encode_file(doc_ids: list[int | None], ids: np.ndarray, bounds: np.ndarray) -> bytes:
    """A file of the documents' ids, given end to end and cut at ``bounds``."""
    ids = ids.astype(np.uint32)
    lengths = np.zeros(ID_BITS + 1, dtype=np.int64)
    for i in range(0, len(ids), STEP):
        size = np.frexp(ids[i : i + STEP].astype(np.float64))[1]  # bits of a whole number; 0 has none
        lengths += np.bincount(np.maximum(size, 1), minlength=ID_BITS + 1)
    widths = best_widths(lengths)
    parts, levels, rest = [], [], ids
    for k, width in enumerate(widths):
        last = k == len(widths) - 1
        levels.append(LEVEL.pack(width, len(rest)))
        parts.append(pack_bits(rest & np.uint32((1 << width) - 1), width))
        if not last:
            rest = rest >> np.uint32(width)
            more = rest > 0
            bitmap = np.packbits(more)
            parts.append(bitmap.tobytes())
            n = len(more)
            ones = np.add.reduceat(more, np.arange(0, n, BLOCK), dtype=np.int64) if n else np.zeros(0, np.int64)
            before = np.cumsum(ones) - ones
            supers = before[:: SUPER // BLOCK]
            parts.append(supers.astype("<u8").tobytes())
            parts.append((before - np.repeat(supers, SUPER // BLOCK)[: len(before)]).astype("<u2").tobytes())
            rest = rest[more]
    named = np.array([d or 0 for d in doc_ids], dtype="<i8").tobytes() + bytes(d is None for d in doc_ids)
    head = HEAD.pack(MAGIC, VERSION, len(widths), len(doc_ids), len(ids)) + b"".join(levels)
    body = b"".join([head, named, bounds.astype("<u8").tobytes(), *parts])
    return body + struct.pack("<I", zlib.crc32(body))


class TokenFile:
    """Reads a file through ``read(offset, size)``: any token, any stretch or any document, or all of it checked."""

    def __init__(self, read, size: int):
        self.read, self.size = read, size
        magic, version, levels, self.n_docs, self.n_ids = HEAD.unpack(self._bytes(0, HEAD.size))
        if magic != MAGIC or version != VERSION:
            raise BadFile("not a token file")
        self.levels = [LEVEL.unpack(self._bytes(HEAD.size + k * LEVEL.size, LEVEL.size)) for k in range(levels)]
        at = HEAD.size + levels * LEVEL.size
        self.docs_at, self.null_at = at, at + 8 * self.n_docs
        self.bounds_at = self.null_at + self.n_docs
        at = self.bounds_at + 8 * (self.n_docs + 1)
        self.places = []
        for k, (width, n) in enumerate(self.levels):
            starts = []
            for part in _sizes(width, n, k == levels - 1):
                starts.append(at)
                at += part
            self.places.append(starts)
        if at + 4 != size or (levels and self.levels[0][1] != self.n_ids):
            raise BadFile(f"{size} bytes where the header tells {at + 4}")

    def _bytes(self, offset: int, size: int) -> bytes:
        data = self.read(offset, size)
        if len(data) != size:
            raise BadFile("cut off")
        return data

    def _array(self, offset: int, n: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._bytes(offset, n * np.dtype(kind).itemsize), dtype=kind)

    def check(self) -> None:
        if zlib.crc32(self._bytes(0, self.size - 4)) != struct.unpack("<I", self._bytes(self.size - 4, 4))[0]:
            raise BadFile("checksum differs")

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """Document ids and the n + 1 places of their first ids."""
        ids = self._array(self.docs_at, self.n_docs, "<i8").tolist()
        null = self._bytes(self.null_at, self.n_docs)
        bounds = self._array(self.bounds_at, self.n_docs + 1, "<u8").astype(np.int64)
        if bounds[0] or bounds[-1] != self.n_ids or (np.diff(bounds) < 0).any():
            raise BadFile("document places out of order")
        return [None if z else d for d, z in zip(ids, null, strict=True)], bounds

    def rank(self, level: int, place: int) -> int:
        """Chunks of the level before ``place`` that go on: two directory entries and less than 512 bits."""
        _, bitmap, supers, blocks = self.places[level]
        if place == self.levels[level][1]:
            return self.levels[level + 1][1]
        ones = int(self._array(supers + place // SUPER * 8, 1, "<u8")[0]) + int(self._array(blocks + place // BLOCK * 2, 1, "<u2")[0])
        start = place // BLOCK * BLOCK
        bits = np.unpackbits(self._array(bitmap + start // 8, (place - start + 7) // 8, "u1"))[: place - start]
        return ones + int(bits.sum())

    def token(self, place: int) -> int:
        """The id at ``place``, without decoding its neighbours."""
        if not 0 <= place < self.n_ids:
            raise IndexError(place)
        return int(self.stretch(place, place + 1)[0])

    def stretch(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b - 1: one rank per level, then its bits in order."""
        out = np.zeros(b - a, dtype=np.uint32)
        at, shift = np.arange(b - a), 0  # places in out that have a chunk at this level, from chunk a on
        for k, (width, _) in enumerate(self.levels):
            n = len(at)
            if not n:
                break
            chunks, bitmap = self.places[k][:2]
            first = a // 8 * 8  # eight chunks begin at a whole byte
            data = self._array(chunks + first // 8 * width, ((a + n - first) * width + 7) // 8, "u1")
            out[at] |= unpack_bits(data, width, a - first, n) << np.uint32(shift)
            if k + 1 < len(self.levels):
                more = np.unpackbits(self._array(bitmap + first // 8, (a + n - first + 7) // 8, "u1"))[a - first : a - first + n]
                at, a = at[more == 1], self.rank(k, a)
            shift += width
        return out


# --- tokens ------------------------------------------------------------------------------------------------------------

# Byte-level pre-tokenisation always cuts before white space that follows something else (of its patterns only those of nothing but
# white space hold any after their first sign) and between a letter and a sign that is neither letter nor white space. A part is
# white space and a word, or what follows a word. What counts as white space differs between libraries beyond ASCII, so a part
# that ends in such a sign goes on.
_GAP, _ODD = r" \t\n\r\x0b\x0c", r"\s\u180e"
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORD = rf"[{_LETTERS}]+(?=[\x00-@\[-`{{-\x7f]|\Z)"
_PART = re.compile(rf"[{_GAP}]*(?:{_WORD}|[^{_GAP}]+(?:(?<=[{_ODD}])[{_GAP}]+[^{_GAP}]*)*)|[{_GAP}]+")
_PLAIN = re.compile(rf" [{_LETTERS}]+")
_CUT = re.compile(rf"(?<=[^{_ODD}])(?=[{_GAP}])")


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Encoder:
    """Ids of texts by the tokenizers library. Texts are cut in front of words, where the library's pre-tokenisation cuts too,
    and the ids of words met before are kept, so each frequent word is encoded once."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()

    def _forget(self) -> None:
        self.number = _Numbers()
        self.coded = np.zeros(0, dtype=np.uint32)
        self.start, self.size = (np.zeros(0, dtype=np.int64) for _ in range(2))

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts end to end and their bounds; none for null and empty texts."""
        if len(self.number) > CACHED_WORDS or len(self.coded) > CACHED_IDS:
            self._forget()
        cut = [_PART.findall(t) if t else [] for t in texts]
        words = np.append(0, np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))))
        which = np.fromiter(map(self.number.__getitem__, chain.from_iterable(cut)), np.int64, words[-1])
        if self.number.new:
            self._learn(self.number.new)
            self.number.new = []
        size = self.size[which]
        bounds = np.append(0, np.cumsum(size))
        ids = self.coded[np.arange(bounds[-1]) + np.repeat(self.start[which] - bounds[:-1], size)]
        return ids, bounds[words]

    def _learn(self, new: list[str]) -> None:
        """Encode the words. Those of a space and letters go as one text each ``JOINED``, for the library counts them apart."""
        plain = [i for i, w in enumerate(new) if _PLAIN.fullmatch(w)]
        rest = sorted(set(range(len(new))).difference(plain))
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        made = self.tokenizer.encode_batch(["".join([new[i] for i in g]) for g in groups], add_special_tokens=False)
        counts = [np.bincount(e.word_ids, minlength=len(g)) for e, g in zip(made, groups, strict=True)]
        if any(len(n) != len(g) or not n.all() for n, g in zip(counts, groups, strict=True)):
            raise ValueError("the tokenizer does not cut words at spaces")
        alone = [e.ids for e in self.tokenizer.encode_batch_fast([new[i] for i in rest], add_special_tokens=False)]
        flat = [np.fromiter(chain.from_iterable(x), np.uint32) for x in ((e.ids for e in made), alone)]
        size = np.zeros(len(new), dtype=np.int64)
        size[plain] = np.concatenate([size[:0], *counts])
        size[rest] = list(map(len, alone))
        order = np.array(plain + rest)
        start = np.zeros(len(new), dtype=np.int64)
        start[order] = len(self.coded) + np.cumsum(size[order]) - size[order]
        self.start, self.size = np.append(self.start, start), np.append(self.size, size)
        self.coded = np.concatenate([self.coded, *flat])

    def documents(self, texts: list[str | None], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """As ``ids``, with ``end_id`` after each text. Long texts go through in stretches."""
        stretches, owner = [], []
        for i, text in enumerate(texts):
            for part in _stretches(text):
                stretches.append(part)
                owner.append(i)
        parts, sizes = [], np.zeros(len(texts), dtype=np.int64)
        first = 0
        while first < len(stretches):
            last, chars = first, 0
            while last < len(stretches) and (last == first or chars + len(stretches[last]) <= STRETCH):
                chars += len(stretches[last])
                last += 1
            ids, bounds = self.ids(stretches[first:last])
            parts.append(ids)
            np.add.at(sizes, owner[first:last], np.diff(bounds))
            first = last
        bounds = np.append(0, np.cumsum(sizes + 1))
        out = np.full(bounds[-1], end_id, dtype=np.uint32)
        inner = np.ones(bounds[-1], dtype=bool)
        inner[bounds[1:] - 1] = False
        if parts:
            out[inner] = np.concatenate(parts)
        return out, bounds


@cache
def _encoder(path: str) -> Encoder:
    """One per Python worker, so its words serve all of the worker's tasks."""
    return Encoder(path)


def _stretches(text: str | None) -> Iterator[str]:
    """The text in stretches of about ``STRETCH`` signs, cut where words are."""
    at = 0
    while text and len(text) - at > STRETCH and (found := _CUT.search(text, at + STRETCH)):
        yield text[at : found.start()]
        at = found.start()
    if text:
        yield text[at:]


# --- DataFrames --------------------------------------------------------------------------------------------------------


def _store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID
) -> DataFrame:
    """Write the ids of all texts, ``end_id`` after each, below ``folder`` (a store that all executors reach) in ascending order
    of ``id_col``, and return the manifest of finished files (part, seq, path, n_docs, n_ids, n_bytes). Files in the order
    of part and seq hold the documents in order.

    ``tokenizer`` is a file that every executor has. Null and empty texts have ``end_id`` alone. Null ids come first; rows
    with one id are ordered by a hash of the text and the text, so a frequent id is spread over tasks. Every row is
    written, repeated rows too; other columns are not read. An empty table gives an empty manifest. A task names each
    attempt's files anew and reports those that it finished, so a lost attempt's files are never read: settle the manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        store, base = _store(folder)
        store.create_dir(base, recursive=True)
        part, encoder = TaskContext.get().partitionId(), _encoder(tokenizer)
        names, codes, bounds, seq = [], [], [np.zeros(1, dtype=np.int64)], 0
        held = 0

        def finish() -> pa.RecordBatch:
            path = f"{base}/{part:06d}-{seq:06d}-{uuid.uuid4().hex}.dac"
            data = encode_file(names, np.concatenate(codes), np.concatenate(bounds))
            with store.open_output_stream(path) as sink:
                sink.write(data)
            row = [part, seq, path, len(names), held, len(data)]
            return pa.RecordBatch.from_arrays([pa.array([v]).cast(k) for v, k in zip(row, _MANIFEST.types, strict=True)], schema=_MANIFEST)

        for batch in batches:
            for a, b in slices(batch.column(1)):
                rows = batch.slice(a, b - a)
                ids, cut = encoder.documents(rows.column(1).to_pylist(), end_id)
                names += rows.column(0).to_pylist()
                codes.append(ids)
                bounds.append(cut[1:] + held)
                held += len(ids)
                if held >= FILE_IDS:
                    yield finish()
                    names, codes, bounds, held, seq = [], [], [np.zeros(1, dtype=np.int64)], 0, seq + 1
        if names:
            yield finish()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return ordered.mapInArrow(run, "part int, seq int, path string, n_docs long, n_ids long, n_bytes long")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with base, the ids in all files before. One row per file of ``FILE_IDS`` ids goes through one task."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame, files: int) -> DataFrame:
    """One row per document of the files in a manifest of ``files`` rows: doc_id, start (place of its first id, counted from
    the first file's), n_tokens, and ids as bytes (32-bit little-endian). Each file's checksum and sizes are checked, or
    ``BadFile`` is raised. Stretches are decoded a million ids at a time; files are spread over tasks."""
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, place = _store(path)
                with store.open_input_file(place) as source:
                    file = TokenFile(lambda offset, n, source=source: source.read_at(n, offset), source.size())
                    file.check()
                    docs, bounds = file.documents()
                    first = 0
                    while first < len(docs):
                        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + STEP, side="right")) - 1)
                        data = file.stretch(int(bounds[first]), int(bounds[last])).astype("<u4").tobytes()
                        cut = (bounds[first : last + 1] - bounds[first]) * 4
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(docs[first:last], pa.int64()),
                                pa.array(bounds[first:last] + start),
                                pa.array(np.diff(cut) // 4),
                                pa.array([data[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)], pa.binary()),
                            ],
                            names,
                        )
                        first = last

    parallel = 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = with_starts(manifest).select("path", "base").repartition(max(1, min(files, parallel)))
    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")

"""SentencePiece encoding and decoding by suffix-array matching.

A batch's distinct words (a text's stretches from one run of spaces to the next; no piece crosses such a border) are
concatenated and indexed by a suffix array over their first ``LONGEST`` characters. Every piece of the vocabulary is found by
binary search as a range of suffixes; the ranges give edges (start, end, piece), which are sorted by their end and relaxed.
The relaxation keeps the merge order: a piece may follow another only if merging the two pieces' text gives the two back, and
of the pieces ending at a place exactly one can then follow what ends at its start. So the result is the model's own merging
and not merely a cheapest path. Characters without piece become byte pieces.

Words relax side by side, a place at a time, so the work is vectors over all words; pairs already judged are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.llm.words import slices

SPACE = "▁"  # fixed value: how the format writes a space
BATCH_BYTES = 4 << 20
KEPT_WORDS = 200_000
_NONE = -1


class Pieces:
    """A merge vocabulary from a model file: pieces with ranks, byte pieces, and judged pairs."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        self.names = names
        self.bytes = np.full(256, model.unk_id(), dtype=np.int64)
        self.of_byte = {}
        self.hidden = {i for i in range(size) if model.is_control(i) or model.is_unknown(i)}
        for i in range(size):
            if model.is_byte(i):
                value = int(names[i][3:5], 16)
                self.bytes[value] = i
                self.of_byte[i] = value
        plain = [i for i in range(size) if not (i in self.of_byte or i in self.hidden or model.is_unused(i))]
        self.rank = {names[i]: -model.get_score(i) for i in plain}
        self.ids = {names[i]: i for i in plain}
        self.longest = max(map(len, self.ids), default=1)
        self.crossing = any(SPACE in p.lstrip(SPACE) for p in self.ids)
        self.letters = np.array(sorted({ord(p) for p in self.ids if len(p) == 1}), dtype=np.uint32)
        if len(self.letters) >= 1 << 15:
            raise ValueError("a vocabulary of more than 32767 letters")
        number = {chr(c): i + 1 for i, c in enumerate(self.letters.tolist())}
        # A piece that holds a letter which is no piece itself cannot come out of merging.
        plain = [i for i in plain if all(c in number for c in names[i])]
        codes = np.zeros((len(plain), self.longest), dtype=np.int64)
        for row, i in enumerate(plain):
            codes[row, : len(names[i])] = [number[c] for c in names[i]]
        self.codes, self.plain = codes, np.array(plain, dtype=np.int64)
        self.lengths = np.array([len(names[i]) for i in plain], dtype=np.int64)
        self.size = size
        written = {i: b"" if i in self.hidden else names[i].replace(SPACE, " ").encode() for i in range(size)}
        written.update({i: bytes([v]) for i, v in self.of_byte.items()})
        self.written = [written[i] for i in range(size)]
        self.cache: dict[str, int] = {}  # a word's number among the coded ones
        self.coded, self.coded_at = np.zeros(0, dtype=np.int64), np.zeros(1, dtype=np.int64)
        self.known = np.zeros(0, dtype=np.int64)
        self.fits = np.zeros(0, dtype=bool)

    def merge(self, text: str) -> list[str]:
        """Merge the adjacent pair with the best rank, the leftmost of equals, until none is a piece."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, before: np.ndarray, piece: np.ndarray) -> np.ndarray:
        """Whether ``piece`` may follow ``before`` (``_NONE``: a word's start)."""
        keys = (before + 1) * self.size + piece
        asked, back = np.unique(keys, return_inverse=True)
        at = np.searchsorted(self.known, asked)
        hit = np.zeros(len(asked), dtype=bool)
        inside = at < len(self.known)
        hit[inside] = self.known[at[inside]] == asked[inside]
        if not hit.all():
            new = asked[~hit]
            fits = []
            for key in new.tolist():
                a, b = divmod(key, self.size)
                want = [self.names[b]] if a == 0 else [self.names[a - 1], self.names[b]]
                fits.append(self.merge("".join(want)) == want)
            self.known, self.fits = np.insert(self.known, at[~hit], new), np.insert(self.fits, at[~hit], fits)
            at = np.searchsorted(self.known, asked)
        return self.fits[at][back]


@cache
def load(path: str) -> Pieces:
    return Pieces(path)


def suffix_array(letters: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Places in the order of the text from there to their segment's end (``ends``), as far as ``longest`` letters: letters
    (16 bits) four at a time, then by doubling. Places that read the same are in any order."""
    n = len(letters)
    place = np.arange(n)
    key, width = letters.astype(np.int64), 1
    for step in range(1, 4):
        at = place + step
        inside = at < ends
        key = key << 16
        key[inside] += letters[at[inside]]
    width = 4
    while width < longest:
        _, rank = np.unique(key, return_inverse=True)
        at = place + width
        inside = at < ends
        key = (rank + 1) * (n + 2)
        key[inside] += rank[at[inside]] + 1
        width *= 2
    return np.argsort(key)


def occurrences(letters: np.ndarray, ends: np.ndarray, pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """(start, index of the piece) of every occurrence of every piece inside the words.

    The suffixes' first characters, as a matrix in suffix order, are binary-searched for all pieces at once, column by
    column: each column narrows every piece's range."""
    order = suffix_array(letters, ends, pieces.longest)
    n = len(order)
    lo, hi = np.zeros(len(pieces.codes), dtype=np.int64), np.full(len(pieces.codes), n, dtype=np.int64)
    for column in range(pieces.longest):
        live = np.flatnonzero((pieces.lengths > column) & (lo < hi))
        if not len(live):
            break
        at = order + column
        text = np.zeros(n, dtype=np.int64)  # 0 ends a suffix and sorts first
        inside = at < ends[order]
        text[inside] = letters[at[inside]]
        want = pieces.codes[live, column]
        lo[live], hi[live] = _bound(text, want, lo[live], hi[live], False), _bound(text, want, lo[live], hi[live], True)
    count = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(count)), count)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return order[lo[which] + inner], which


def _bound(text, want, lo, hi, after: bool) -> np.ndarray:
    lo, hi = lo.copy(), hi.copy()
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) // 2
        value = text[np.minimum(mid, len(text) - 1)]
        right = open_ & ((value <= want) if after else (value < want))
        lo = np.where(right, mid + 1, lo)
        hi = np.where(open_ & ~right, mid, hi)


def encode_words(words: list[str], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the words end to end and each word's bounds in them, by the lattice of the batch."""
    joined = "".join(words)
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    stop = np.cumsum(sizes)
    # A character without piece is a border: it stands alone and nothing merges over it.
    place = np.minimum(np.searchsorted(pieces.letters, codes), len(pieces.letters) - 1)
    odd = pieces.letters[place] != codes
    letters = np.where(odd, 0, place + 1)
    cut = np.zeros(len(codes) + 1, dtype=bool)
    cut[stop - sizes] = True
    cut[:-1] |= odd
    cut[1:] |= odd
    begins = np.flatnonzero(cut[:-1])
    segment = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(codes))))
    ends = np.append(begins[1:], len(codes))[segment]
    start, which = occurrences(letters, ends, pieces)
    end = start + pieces.lengths[which]
    piece = pieces.plain[which]
    # Places count from their segment's begin; edges are relaxed in the order of that count.
    depth = end - begins[segment[start]]
    order = np.argsort(depth.astype(np.uint16), kind="stable") if depth.max(initial=0) < 1 << 16 else np.argsort(depth)
    start, end, piece, depth = start[order], end[order], piece[order], depth[order]
    last = np.full(len(codes) + 1, _NONE, dtype=np.int64)  # piece that ends in front of a place, within its segment
    for a, b in _runs(depth):
        s, e, p = start[a:b], end[a:b], piece[a:b]
        first = s == begins[segment[s]]
        before = np.where(first, _NONE, last[s])
        can = first | (before != _NONE)
        s, e, p, before = s[can], e[can], p[can], before[can]
        good = pieces.may_follow(before, p)
        last[e[good]] = p[good]
    return _walk_back(joined, codes, odd, begins, last, pieces, stop, sizes)


def _runs(depth: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(depth[1:] != depth[:-1]) + 1
    return zip([0, *cuts.tolist()] if len(depth) else [], [*cuts.tolist(), len(depth)] if len(depth) else [], strict=True)


def _walk_back(joined, codes, odd, begins, last, pieces, stop, sizes) -> tuple[np.ndarray, np.ndarray]:
    """Read the kept pieces from every segment's end to its begin, all segments side by side."""
    at = np.append(begins[1:], len(codes))
    length = np.zeros(pieces.size, dtype=np.int64)
    length[pieces.plain] = pieces.lengths
    places, found = [], []
    live = np.flatnonzero(~odd[begins]) if len(begins) else np.zeros(0, np.int64)
    while len(live):
        p = last[at[live]]
        if (p == _NONE).any():
            raise RuntimeError("no piece ends where a segment must be cut")
        at[live] -= length[p]
        places.append(at[live].copy())
        found.append(p)
        live = live[at[live] > begins[live]]
    for place in np.flatnonzero(odd).tolist():
        raw = np.frombuffer(joined[place].encode("utf-8", "surrogatepass"), dtype=np.uint8)
        places.append(np.full(len(raw), place))
        found.append(pieces.bytes[raw])
    if not places:
        return np.zeros(0, dtype=np.int64), np.zeros(len(sizes) + 1, dtype=np.int64)
    place, ids = np.concatenate(places), np.concatenate(found)
    order = np.argsort(place, kind="stable")
    place, ids = place[order], ids[order]
    return ids, np.searchsorted(place, np.append(0, stop))


def cut_words(text: str, pieces: Pieces) -> list[str]:
    """A text's words, each without the space in front that the format writes before it: stretches from one run of spaces to
    the next, or the whole text if pieces cross such borders."""
    if SPACE in text:
        text = text.replace(SPACE, " ")
    if pieces.crossing:
        return [text.replace(" ", SPACE)]
    if "  " not in text and text[:1] != " " and text[-1:] != " ":
        return text.split(" ")
    words, run = [], ""
    for part in text.split(" "):
        if part:
            words.append(run + part)
            run = ""
        else:
            run += SPACE
    # Spaces at the end: one fewer sign than empty parts, for a word writes its own.
    return [*words, run[1:]] if run else words


def _stretches(values: np.ndarray, at: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of ``values``, cut at ``at``, end to end, and their bounds."""
    size = at[which + 1] - at[which]
    bounds = np.append(0, np.cumsum(size))
    return values[np.arange(bounds[-1]) + np.repeat(at[which] - bounds[:-1], size)], bounds


def encode_batch(texts: list[str | None], pieces: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Piece ids of the texts end to end and each text's bounds in them; none for null and empty texts. Words met before are
    kept, about ``KEPT_WORDS``."""
    cut = [cut_words(t, pieces) if t else [] for t in texts]
    words_here = set(chain.from_iterable(cut))
    if len(pieces.cache) > KEPT_WORDS:  # words of the batch at hand stay, so common words are coded once
        kept = list(words_here.intersection(pieces.cache))
        which = np.fromiter(map(pieces.cache.__getitem__, kept), np.int64, len(kept))
        pieces.coded, pieces.coded_at = _stretches(pieces.coded, pieces.coded_at, which)
        pieces.cache = dict(zip(kept, range(len(kept)), strict=True))
    cache = pieces.cache
    new = list(words_here.difference(cache))
    if new:
        ids, at = encode_words([SPACE + w for w in new], pieces)
        pieces.coded_at = np.append(pieces.coded_at, pieces.coded_at[-1] + at[1:])
        pieces.coded = np.append(pieces.coded, ids)
        cache.update(zip(new, range(len(cache), len(cache) + len(new)), strict=True))
    words = np.append(0, np.cumsum(np.fromiter(map(len, cut), np.int64, len(cut))))
    which = np.fromiter(map(cache.__getitem__, chain.from_iterable(cut)), np.int64, words[-1])
    ids, bounds = _stretches(pieces.coded, pieces.coded_at, which)
    return ids, bounds[words]


def decode_ids(ids, pieces: Pieces) -> str:
    """Text of piece ids: byte pieces as UTF-8 with U+FFFD for what is none, control pieces as nothing, and without the space
    in front that encoding adds."""
    text = b"".join(map(pieces.written.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(docs: DataFrame, model: str, text_col: str = "text", keep: list[str] | None = None, verify: bool = False) -> DataFrame:
    """The columns ``keep`` with piece_ids; with ``verify`` also round_trip, whether decoding gives the text back (a text that
    itself holds the format's sign for a space comes back with a space there, and counts as back).

    ``model`` is a path that every executor has. Null texts have null ids, empty texts none.
    """
    keep = keep or []
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            for a, b in slices(batch.column(n), BATCH_BYTES):
                part = batch.slice(a, b - a)
                texts = part.column(n).to_pylist()
                ids, bounds = encode_batch(texts, pieces)
                null = pa.array([t is None for t in texts], pa.bool_())
                columns = [*part.columns[:n], pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids), mask=null)]
                if verify:
                    coded = map(np.ndarray.tolist, np.split(ids, bounds[1:-1]))
                    back = [t is None or decode_ids(x, pieces) == t.replace(SPACE, " ") for t, x in zip(texts, coded, strict=True)]
                    columns.append(pa.array(back, pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string"))
    source = source.toDF(*[f"c{i}" for i in range(n)], "text")
    kinds = [f"c{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])]
    out = [f"c{n} array<long>"] + ([f"c{n + 1} boolean"] if verify else [])
    return source.mapInArrow(run, ", ".join(kinds + out)).toDF(*keep, "piece_ids", *(["round_trip"] if verify else []))


def decode(coded: DataFrame, model: str, ids_col: str = "piece_ids", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` with text; null ids give null."""
    keep = keep or []
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load(model)
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids, pieces) for ids in batch.column(n).to_pylist()]
            columns = [*batch.columns[:n], pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    source = coded.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{ids_col}`")).toDF(*[f"c{i}" for i in range(n)], "ids")
    kinds = [f"c{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])]
    return source.mapInArrow(run, ", ".join([*kinds, f"c{n} string"])).toDF(*keep, "text")

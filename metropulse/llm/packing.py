"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted, each with a cost. Pieces go, longest first, into the open bin with the least room
that still takes them. When none does, the length is opened whose cost per token that it can be filled with from the pieces
still to come is least. At the end each bin shrinks to the least permitted length that holds its contents.

Documents are dealt to blocks by a hash of their id and text digest; a block of about ``BLOCK_ROWS`` documents is packed in
one task from (id, length) alone. Each block leaves a few bins short, so the loss falls with the block's size, and the
number of blocks follows the input. The result depends on the rows only, not on how they were partitioned.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.operators.staging import join_sized, settle

BLOCK_ROWS = 16_384
#: Cost of a sequence by its length: linear work plus attention's quadratic part.
LENGTHS = {n: n + n * n / 32_768 for n in (512, 1024, 2048, 4096)}

_OUT = "doc_id long, piece int, start long, length int, block long, bin int, capacity int, offset int"


def word_tokens(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` and one end."""
    marks = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\x20\x09-\x0D]++", "w")
    return (F.length(F.translate(marks, " \t\n\x0b\x0c\r", "")) + 1).cast("bigint")


def _least_cost(left: list[int], counts: dict[int, int], first: int, costs: Mapping[int, float]) -> int:
    """The permitted length with the least cost per token when filled greedily, ``first`` to begin with."""
    best = None
    for capacity in sorted(costs):
        if capacity < first:
            continue
        room, full = capacity - first, first
        at = len(left)
        while room > 0 and at:
            at = bisect_left(left, room + 1, 0, at)
            if not at:
                break
            size = left[at - 1]
            take = min(room // size, counts[size] - (size == first))
            room -= take * size
            full += take * size
            at -= 1
        price = costs[capacity] / full
        if best is None or price < best[0]:
            best = (price, capacity)
    return best[1]


def pack(lengths: np.ndarray, costs: Mapping[int, float]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin, capacity of the bin and offset in it for pieces of the given lengths, none longer than the longest permitted.
    Equal lengths are taken in the order given."""
    order = np.argsort(-lengths, kind="stable")
    sizes, times = np.unique(lengths, return_counts=True)
    left = sizes.tolist()
    counts = dict(zip(left, times.tolist(), strict=True))
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    held: dict[int, list[int]] = {}
    used: list[int] = []
    for i in order.tolist():
        size = int(lengths[i])
        at = bisect_left(rooms, size)
        if at < len(rooms):
            room = rooms[at]
            which = held[room].pop()
            if not held[room]:
                del held[room], rooms[at]
        else:
            room = _least_cost(left, counts, size, costs)
            which = len(used)
            used.append(0)
        bins[i], offsets[i] = which, used[which]
        used[which] += size
        room -= size
        if room:
            if room not in held:
                insort(rooms, room)
                held[room] = []
            held[room].append(which)
        counts[size] -= 1
        if not counts[size]:
            del counts[size], left[bisect_left(left, size)]
    allowed = sorted(costs)
    shrunk = np.array([allowed[bisect_left(allowed, u)] for u in used], dtype=np.int64)
    return bins, shrunk[bins] if len(bins) else bins, offsets


def _pack_block(costs: Mapping[int, float]):
    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "id", "piece"], kind="stable", na_position="last")
        bins, capacity, offset = pack(group["length"].to_numpy(np.int64), costs)
        out = group[["id", "piece", "start", "length", "block"]].rename(columns={"id": "doc_id"})
        return out.assign(bin=bins, capacity=capacity, offset=offset)

    return run


def best_fit_pack(
    docs: DataFrame,
    length: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    costs: Mapping[int, float] = LENGTHS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per piece: doc_id, piece (from 0), start and length in the document's tokens, and its block, bin within the
    block, bin capacity and offset in the bin.

    Documents longer than the longest permitted length are cut into pieces of that length and a rest. A document of length
    0 or null is left out; a null id is packed like any other; repeated rows are packed once each; an empty table gives an
    empty result. Copies of one text under one id share a hash, and beyond ``block_rows`` of them fall into several
    blocks by their place in the measured table.
    """
    costs = dict(costs)
    longest = max(costs)
    key = F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    measured = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), key.alias("h"), length.cast("long").alias("n"))
    measured = settle(measured.where("n > 0"), "pack-lengths")
    lengths = measured.df
    blocks = max(1, -(-measured.rows // block_rows))
    again = lengths.groupBy("h").agg(F.count("*").alias("k")).where(F.col("k") > block_rows)
    often = settle(again.select("h", F.lit(True).alias("often")), "pack-often")
    placed = lengths.select("*", F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("row"))
    placed = join_sized(placed, often, ["h"])
    place = F.when(F.col("often"), F.col("row")).otherwise(F.xxhash64("h"))
    pieces = placed.withColumn("block", F.pmod(place, F.lit(blocks))).select(
        "id", "h", "n", "block", F.explode(F.sequence(F.lit(0), ((F.col("n") - 1) / longest).cast("int"))).alias("piece")
    )
    start = F.col("piece").cast("long") * longest
    pieces = pieces.select(
        "id", "h", "piece", start.alias("start"), F.least(F.lit(longest), F.col("n") - start).cast("int").alias("length"), "block"
    )
    return pieces.groupBy("block").applyInPandas(_pack_block(costs), _OUT)

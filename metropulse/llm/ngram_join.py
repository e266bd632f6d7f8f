"""Jaccard self-join of documents on word shingles with adaptive multi-match prefixes.

Shingles are ordered from rare to common. Two sets that are similar enough share at least l shingles among the first
``n - ceil(t * n) + l`` of each, for every l. A document takes the l with the least estimated cost: a longer prefix has
more entries to look up, yet a pair must then share ``min(l, l')`` of them before it is compared in full.

The steps, each a Spark job over packed arrays (a row of a shuffle holds a slice's entries for one bucket):

1. Set size and 128-bit digest of every document; equal sets become one node.
2. Entries are dealt by shingle; a bucket counts each shingle's nodes and returns entries found in two nodes or more.
   A shingle of a single node cannot be shared, so only its number matters.
3. Returned entries are dealt by node, ordered by (count, shingle), and the prefix is chosen.
4. Nodes that share enough prefix shingles are compared in full. A list of up to ``LONG_LIST`` nodes gives pairs; longer
   lists join their nodes to clusters, compared block against block, where a task emits only links that join components.
5. Links give components.

Hot groups: copies beyond ``HOT_COPIES`` of the rows leave only their first id before step 2 (at most 1 / HOT_COPIES such
groups exist). Shingles in more than ``HOT_SHINGLE`` of the documents are found per slice in step 1, skip the count, count
as most common, and travel by node.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.llm.graph import components
from metropulse.llm.words import mix, set_digests, shingle_sets, slices
from metropulse.operators.staging import settle

SHUFFLE_ENTRIES = 1 << 22
MIN_BITS = 4
HOT_COPIES = 1 / 10_000
HOT_SHINGLE = 1 / 500
HOT_DF = np.uint32(0xFFFFFFFF)
MAX_MATCHES = 8
COMPARE_COST = 32
#: Shingles of so many nodes or more bring their nodes together in blocks, not as pairs.
LONG_LIST = 64
BLOCK_NODES = 256
BLOCK_ENTRIES = 1 << 20
COLUMNS = 1 << 14

_PACKED = "bucket int, hot boolean, nodes binary, sizes binary, counts binary, low binary, high binary"
_RETURNED = "bucket int, nodes binary, sizes binary, counts binary, tokens binary, freqs binary"
_NODES = "node long, n long, matches int, short array<long>, long array<long>, tokens array<long>"


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                sets, at = shingle_sets(part.column(1), width)
                d1, d2 = set_digests(sets, at)
                rows = len(part)
                distinct, times = np.unique(sets, return_counts=True)
                heavy = times >= max(2, math.ceil(rows * HOT_SHINGLE))
                k = int(heavy.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([part.column(0).cast(pa.int64()), pa.nulls(k, pa.int64())]),
                        pa.array(np.concatenate([np.diff(at), times[heavy]]).astype(np.int64)),
                        pa.array(np.concatenate([d1, distinct[heavy].view(np.int64)])),
                        pa.array(np.concatenate([d2, np.zeros(k, dtype=np.int64)])),
                        pa.array(np.arange(rows + k) >= rows),
                        pa.concat_arrays([part.column(2), pa.nulls(k, pa.int64())]),
                    ],
                    ["id", "n", "d1", "d2", "heavy", "text_hash"],
                )

    return run


def _emit(width: int, bits: int, copies: dict, clashes: set, hot: np.ndarray):
    """Entries of every slice by shingle bucket: 48 bits each beside the bucket's, in document order with counts."""
    drop = np.uint64(max(0, 16 - bits))

    def packed(bucket, is_hot, row, low, nodes, sizes):
        used, first = np.unique(row, return_index=True)
        counts = np.diff(np.append(first, len(row)))
        small = counts.max() < 255  # one byte each, or a 255 in front of four
        return (
            int(bucket),
            is_hot,
            nodes[used].tobytes(),
            sizes[used].astype(np.int32).tobytes(),
            counts.astype(np.uint8).tobytes() if small else b"\xff" + counts.astype(np.int32).tobytes(),
            low.astype(np.uint32).tobytes(),
            (low >> np.uint64(32)).astype(np.uint32 if is_hot else np.uint16).tobytes(),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.bool_()] + [pa.binary()] * 5
        names = [f.split()[0] for f in _PACKED.split(", ")]
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                sets, at = shingle_sets(part.column(1), width)
                sizes = np.diff(at)
                d1, d2 = set_digests(sets, at)
                ids = part.column(0).cast(pa.int64())
                keep = (sizes > 0) & ~np.asarray(ids.is_null())
                ids = np.asarray(ids.fill_null(0))
                nodes = np.where(np.isin(d1, np.array(list(clashes), dtype=np.int64)), d2, d1) if clashes else d1
                if copies:
                    seen = zip(nodes.tolist(), ids.tolist(), strict=True)
                    keep &= np.array([copies.get(x, i) == i for x, i in seen], dtype=bool)
                able = np.flatnonzero(keep)
                _, first = np.unique(nodes[able], return_index=True)  # equal sets of a slice go once
                keep = np.zeros(len(nodes), dtype=bool)
                keep[able[first]] = True
                row = np.repeat(np.arange(len(sizes)), sizes)
                is_hot = np.isin(sets, hot)
                out = []
                cold = keep[row] & ~is_hot
                if cold.any():
                    s, r = sets[cold], row[cold]
                    bucket = (s >> np.uint64(64 - bits)).astype(np.int64)
                    low = (s >> drop) & np.uint64((1 << 48) - 1)
                    order = np.argsort(bucket, kind="stable")
                    r, bucket, low = r[order], bucket[order], low[order]
                    cuts = np.flatnonzero(np.diff(bucket)) + 1
                    for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(bucket)], strict=True):
                        out.append(packed(bucket[x], False, r[x:y], low[x:y], nodes, sizes))
                warm = keep[row] & is_hot
                if warm.any():
                    spot = int(mix(nodes[row[warm]][:1].view(np.uint64))[0] >> np.uint64(64 - bits))
                    out.append(packed(spot, True, row[warm], sets[warm] >> drop, nodes, sizes))
                if out:
                    columns = [pa.array(list(c), k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _joined(values, kind) -> np.ndarray:
    return np.frombuffer(b"".join(values), dtype=kind)


def _sizes(values) -> np.ndarray:
    parts = [np.frombuffer(v[1:], np.int32) if v[:1] == b"\xff" else np.frombuffer(v, np.uint8) for v in values]
    return np.concatenate(parts).astype(np.int64)


def _count(bits: int):
    """In a bucket: nodes of every shingle, and entries of shingles with two nodes or more, by node bucket."""
    wide = np.uint64(min(48, 64 - bits))

    def returned(nodes, sizes, node, token, freq):
        to = (mix(nodes[node].view(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64)
        order = np.lexsort((node, to))
        node, token, freq, to = node[order], token[order], freq[order], to[order]
        cuts = np.flatnonzero(np.diff(to)) + 1
        for x, y in zip([0, *cuts.tolist()], [*cuts.tolist(), len(to)], strict=True):
            if y > x:
                used, first = np.unique(node[x:y], return_index=True)
                counts = np.diff(np.append(first, y - x)).astype(np.int32)
                yield (
                    int(to[x]),
                    nodes[used].tobytes(),
                    sizes[used].tobytes(),
                    counts.tobytes(),
                    token[x:y].tobytes(),
                    freq[x:y].astype(np.uint32).tobytes(),
                )

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        out = []
        hot = group[group["hot"]]
        for r in hot.itertuples(index=False):
            low, high = np.frombuffer(r.low, np.uint32), np.frombuffer(r.high, np.uint32)
            token = (high.astype(np.uint64) << np.uint64(32)) | low
            counts = _sizes([r.counts])
            node = np.repeat(np.arange(len(counts)), counts)
            nodes, sizes = np.frombuffer(r.nodes, np.int64), np.frombuffer(r.sizes, np.int32)
            out += returned(nodes, sizes, node, token, np.full(len(token), HOT_DF))
        cold = group[~group["hot"]]
        if len(cold):
            nodes, sizes, counts = _joined(cold["nodes"], np.int64), _joined(cold["sizes"], np.int32), _sizes(cold["counts"])
            nodes, first, place = np.unique(nodes, return_index=True, return_inverse=True)
            sizes = sizes[first]
            node = np.repeat(place, counts)
            low = _joined(cold["high"], np.uint16).astype(np.uint64) << np.uint64(32)
            low |= _joined(cold["low"], np.uint32)
            order = np.lexsort((node, low))
            node, low = node[order], low[order]
            single = np.ones(len(low), dtype=bool)
            single[1:] = (low[1:] != low[:-1]) | (node[1:] != node[:-1])
            node, low = node[single], low[single]
            new = np.ones(len(low), dtype=bool)
            new[1:] = low[1:] != low[:-1]
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(low)))
            freq = np.repeat(times, times)
            shared = freq > 1
            low = low & np.uint64((1 << int(wide)) - 1)
            token = (np.uint64(int(key[0])) << wide) | low
            out += returned(nodes, sizes, node[shared], token[shared], freq[shared])
        return pd.DataFrame(out, columns=[f.split()[0] for f in _RETURNED.split(", ")])

    return run


def _choose(percent: int):
    """Order each node's shared entries and pick its number of matches and prefix."""

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids, sizes = _joined(group["nodes"], np.int64), _joined(group["sizes"], np.int32)
        counts = _joined(group["counts"], np.int32)
        token, freq = _joined(group["tokens"], np.uint64), _joined(group["freqs"], np.uint32)
        entry = np.repeat(np.arange(len(ids)), counts)
        order = np.lexsort((token, freq, ids[entry]))
        token, freq, entry = token[order], freq[order], entry[order]
        owner = ids[entry]
        starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
        out = []
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(owner)).tolist(), strict=True):
            n = int(sizes[entry[a]])
            alone = n - (b - a)  # entries of no other node come first in the order
            least = -(-percent * n // 100)
            base = n - least - alone
            if base + min(MAX_MATCHES, least) < 1:
                continue
            reach = np.minimum(np.cumsum(freq[a:b], dtype=np.float64), 1e18)
            best = None
            for matches in range(1, min(MAX_MATCHES, least) + 1):
                length = base + matches
                work = 0.0 if length < 1 else reach[min(length, b - a) - 1]
                cost = work + COMPARE_COST * work / matches
                if best is None or cost < best[0]:
                    best = (cost, matches, length)
            _, matches, length = best
            if length < matches:  # too few shared entries for any pair
                continue
            length = min(length, b - a)
            while length < b - a and freq[a + length] == freq[a + length - 1] and token[a + length] == token[a + length - 1]:
                length += 1
            signed = token[a:b].view(np.int64)
            cut = min(length, int(np.searchsorted(freq[a:b], LONG_LIST)))
            out.append((int(owner[a]), n, matches, signed[:cut], signed[cut:length], signed))
        return pd.DataFrame(out, columns=["node", "n", "matches", "short", "long", "tokens"])

    return run


def _linked(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold; shared entries alone can meet."""
    side = nodes.select("node", "n", "tokens")
    x = side.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    y = side.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(x, "a").join(y, "b").where(100 * both >= percent * (F.col("na") + F.col("nb") - both)).select("a", "b")


def _near_sizes(x: str, y: str, percent: int):
    return (100 * F.col(x) >= percent * F.col(y)) & (100 * F.col(y) >= percent * F.col(x))


def _pairs(nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs with enough common entries of short lists. A pair that also meets in a long list is compared there anyway."""
    postings = nodes.select("node", "n", "matches", F.explode("short").alias("token"))
    x, y = postings.toDF("a", "na", "la", "token"), postings.toDF("b", "nb", "lb", "token")
    met = x.join(y, "token").where((F.col("a") < F.col("b")) & _near_sizes("na", "nb", percent))
    counted = met.groupBy("a", "b").agg(F.count("*").alias("k"), F.min(F.least("la", "lb")).alias("need"))
    return counted.where("k >= need").select("a", "b")


def _roots(parent: np.ndarray) -> np.ndarray:
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return parent


def _compare(percent: int):
    """Links between two blocks of nodes, as many as join what they join. Shared entries are counted as a matrix product, so
    many columns at a time."""

    def grid(tokens, columns: np.ndarray) -> np.ndarray:
        out = np.zeros((len(tokens), len(columns)), dtype=np.float32)
        for i, t in enumerate(tokens):
            at = np.minimum(np.searchsorted(columns, t), len(columns) - 1)
            out[i, at[columns[at] == t]] = 1
        return out

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                xs, ys = list(r.x), list(r.y)
                common = np.intersect1d(np.concatenate([v["tokens"] for v in xs]), np.concatenate([v["tokens"] for v in ys]))
                both = np.zeros((len(xs), len(ys)))
                for c in range(0, len(common), COLUMNS):
                    columns = common[c : c + COLUMNS]
                    both += grid([v["tokens"] for v in xs], columns) @ grid([v["tokens"] for v in ys], columns).T
                na, nb = (np.array([v["n"] for v in side], dtype=np.float64) for side in (xs, ys))
                a, b = (np.array([v["node"] for v in side], dtype=np.int64) for side in (xs, ys))
                i, j = np.nonzero((100 * both >= percent * (na[:, None] + nb[None] - both)) & (a[:, None] != b[None]))
                out, ids = [], np.unique(np.concatenate([a, b]))
                parent = np.arange(len(ids))
                u, v = np.searchsorted(ids, a[i]), np.searchsorted(ids, b[j])
                while len(u):  # each turn joins every tree to a smaller neighbour by one of its links
                    high, low = np.maximum(parent[u], parent[v]), np.minimum(parent[u], parent[v])
                    keep = high != low
                    u, v, high, low = u[keep], v[keep], high[keep], low[keep]
                    trees, first = np.unique(high, return_index=True)
                    out.append(np.stack([ids[u[first]], ids[v[first]]]))
                    parent[trees] = low[first]
                    parent = _roots(parent)
                links = np.concatenate(out, axis=1) if out else np.zeros((2, 0), dtype=np.int64)
                yield pd.DataFrame({"a": links[0], "b": links[1]})

    return run


def _block_links(nodes: DataFrame, percent: int) -> DataFrame:
    """Links between nodes that long lists bring together, directly or through others: each such cluster is dealt into
    blocks, and a task compares two blocks without a row per pair."""
    postings = nodes.select("node", F.explode("long").alias("token"))
    least = postings.groupBy("token").agg(F.min("node").alias("to"))
    edges = postings.join(least, "token").where("node <> to").select("node", "to").distinct()
    cluster = components(edges, "shingle-clusters").withColumnRenamed("component", "cluster")
    held = cluster.join(nodes.select("node", "n", "tokens"), "node")
    sizes = held.groupBy("cluster").agg(F.count("*").alias("k"), F.sum(F.size("tokens")).alias("t"))
    wanted = F.greatest(F.ceil(F.col("k") / BLOCK_NODES), F.ceil(F.col("t") / BLOCK_ENTRIES)).cast("long")
    held = held.join(sizes.select("cluster", wanted.alias("blocks")), "cluster")
    block = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks"))
    blocks = held.groupBy("cluster", block.alias("block")).agg(F.collect_list(F.struct("node", "n", "tokens")).alias("x"))
    blocks = settle(blocks, "shingle-blocks").df
    other = blocks.withColumnRenamed("block", "other").withColumnRenamed("x", "y")
    met = blocks.join(other, "cluster").where("block <= other").select("x", "y")
    return met.mapInPandas(_compare(percent), "a long, b long")


def ngram_jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5
) -> DataFrame:
    """(``id_col``, n_shingles, component_id), one row per row of ``docs``.

    component_id is the smallest id reachable through pairs with ``100 * |A and B| >= percent * |A or B|``. Null or empty
    texts have no shingles and stand alone. A row without id links with nothing and has a null component. Rows that share
    an id are documents of their own with that id. Repeated rows come back as often as they went in. An empty table gives
    an empty result. Other columns are not read.
    """
    return row_components(docs, id_col, text_col, percent, width).select(id_col, "n_shingles", "component_id")


def row_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 75, width: int = 5
) -> DataFrame:
    """As ``ngram_jaccard_components``, with text_hash (xxhash64 of the text), which tells rows that share an id apart, and
    component, which tells components apart whose smallest ids are equal (null where a row links with nothing by rule)."""
    text = F.col(f"`{text_col}`").cast("string")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    hashed = source.withColumn("text_hash", F.xxhash64("text"))
    seen = settle(
        hashed.mapInArrow(_describe(width), "id long, n long, d1 long, d2 long, heavy boolean, text_hash long"), "shingle-sets"
    ).df
    sized = seen.where("not heavy").drop("heavy")
    rows, total = sized.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    linkable = sized.where("n > 0 and id is not null")
    groups = linkable.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.count("*").alias("k"))
    # Two sets meet in 64 bits about once in rows squared / 2^65: a handful. Those are known by their other half.
    clashes = {r.d1 for r in groups.groupBy("d1").count().where("count > 1").collect()}
    node = F.when(F.col("d1").isin(list(clashes)), F.col("d2")).otherwise(F.col("d1")) if clashes else F.col("d1")
    groups = settle(groups.select(node.alias("node"), "id", "k"), "shingle-groups").df
    # At most 1 / HOT_COPIES groups hold more than that share of the rows.
    many = groups.where(F.col("k") > max(64, rows * HOT_COPIES)).collect()
    copies = {r.node: r.id for r in many}
    common = seen.where("heavy").groupBy("d1").agg(F.sum("n").alias("k")).where(F.col("k") > max(1000, rows * HOT_SHINGLE))
    hot = np.array([r.d1 for r in common.select("d1").collect()], dtype=np.int64).view(np.uint64)
    bits = max(MIN_BITS, math.ceil(math.log2(max(1, total / SHUFFLE_ENTRIES))))

    entries = source.mapInArrow(_emit(width, bits, copies, clashes, hot), _PACKED)
    shared = entries.groupBy("bucket").applyInPandas(_count(bits), _RETURNED)
    nodes = settle(shared.groupBy("bucket").applyInPandas(_choose(percent), _NODES), "shingle-prefixes").df

    links = _linked(_pairs(nodes, percent), nodes, percent).union(_block_links(nodes, percent))
    joined = components(settle(links, "shingle-links").df, "shingle-components")
    named = groups.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("id").alias("component_id"))
    named = named.join(least, "component").select("node", "component", "component_id")
    out = sized.withColumn("node", F.when(F.col("id").isNotNull() & (F.col("n") > 0), node)).join(named, "node", "left")
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
        "text_hash",
        "component",
    )

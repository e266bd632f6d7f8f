"""Near-duplicate vectors by NN-descent: neighbour lists improved by comparing neighbours of neighbours.

Only vectors with the same label are compared. Equal vectors (bit for bit) are one node with a count. Lists begin with the
best neighbours in leaves: vectors sorted along random codes and cut into runs. A round joins each node's list and reverse
list and compares their members with one another; rounds go on while lists change. Then links at the threshold give
components. A saturated node, whose whole list reaches the threshold, may have links that its list had no place for, so its list
is doubled and filled by further rounds, up to ``LONGEST``; nodes saturated even then are compared between components: their blocks by bounding balls, which lose no pair, and blocks
whose balls come near enough in full. Links found so join components. A component's members are then compared in full,
block against block. An audit compares nodes chosen by hash, more of them in larger tables, with all vectors of their
label; every node counts alike, in classes by its number of links. While the least class is under the target and rising,
descent goes on from twice as many new leaves; when it no longer rises, or no audited node has a link to measure by, all blocks of a
label are compared with one another.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metropulse.llm.graph import components
from metropulse.llm.vectors import Rows, by_length, packed, unpack, usable
from metropulse.operators.staging import settle

NEIGHBOURS = 12
#: Saturated lists are doubled up to this; nodes saturated even then are compared in blocks.
LONGEST = 48
LEAF = 64
TREES = 2
BITS = 24
ROUNDS = 4
STILL = 0.02
BLOCK = 512
AUDIT = 256
#: Audited vectors travel to every task, so their bytes are bounded.
AUDIT_BYTES = 32 << 20
RECALL = 0.98
#: Audited nodes with links that are looked for.
LINKED = 64

_EDGES = "u long, v long, sim double"


def _vectors(df: DataFrame) -> DataFrame:
    """(node, label, x): packed unit vectors."""
    return packed(df, ["node", "label"], "x", unit=True)


def _code(vectors: DataFrame, seed: int) -> DataFrame:
    """Signs of random projections as a number, ordered along a Gray code so that neighbouring codes differ in one sign,
    and one more projection within a code."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            if not len(part):
                continue
            for at, x in by_length(part["x"]):
                planes = np.random.default_rng(seed).standard_normal((x.shape[1], BITS + 1))
                y = x @ planes
                signs = (y[:, :BITS] > 0).astype(np.int64)
                code = np.zeros(len(x), dtype=np.int64)
                bit = np.zeros(len(x), dtype=np.int64)
                for j in range(BITS):
                    bit ^= signs[:, j]
                    code = code * 2 + bit
                yield part.iloc[at].assign(code=code, along=y[:, BITS])

    return vectors.mapInPandas(run, "node long, label long, x binary, code long, along double")


def _top(u: np.ndarray, v: np.ndarray, sim: np.ndarray, k: int) -> pd.DataFrame:
    order = np.lexsort((v, -sim, u))
    u, v, sim = u[order], v[order], sim[order]
    same = np.zeros(len(u), dtype=bool)
    same[1:] = (u[1:] == u[:-1]) & (v[1:] == v[:-1])
    u, v, sim = u[~same], v[~same], sim[~same]
    first = np.flatnonzero(np.append(True, u[1:] != u[:-1])) if len(u) else np.zeros(0, np.int64)
    rank = np.arange(len(u)) - np.repeat(first, np.diff(np.append(first, len(u))))
    keep = rank < k
    return pd.DataFrame({"u": u[keep], "v": v[keep], "sim": sim[keep]})


def _pairs_of(nodes: np.ndarray, x: np.ndarray, k: int) -> pd.DataFrame:
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    k = min(k, len(nodes) - 1)
    best = np.argpartition(-sims, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(nodes), 0), np.int64)
    return pd.DataFrame(
        {"u": np.repeat(nodes, k), "v": nodes[best].ravel(), "sim": np.take_along_axis(sims, best, axis=1).ravel()}
    )


def _leaf_edges(vectors: DataFrame, seed: int, k: int) -> DataFrame:
    """Best neighbours within runs of ``LEAF`` of a range sort, so a crowded code is cut like any other."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            labels = part["label"].to_numpy()
            nodes, out = part["node"].to_numpy(), []
            x = Rows(part["x"])  # a label has one length
            edges = [0, *(np.flatnonzero(labels[1:] != labels[:-1]) + 1).tolist(), len(part)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                runs = max(1, round((b - a) / LEAF))
                for run_ in np.array_split(np.arange(a, b), runs):
                    if len(run_) > 1:
                        out.append(_pairs_of(nodes[run_], x[run_[0] : run_[-1] + 1], k))
            if out:
                yield pd.concat(out)

    order = ["label", "code", "along", "node"]
    return _code(vectors, seed).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(run, _EDGES)


def _best(edges: DataFrame, k: int) -> DataFrame:
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return once.withColumn("r", rank).where(F.col("r") <= k).drop("r")


def _round(vectors: DataFrame, lists: DataFrame, k: int, only: DataFrame | None = None) -> DataFrame:
    """Compare the members of each node's list and reverse list (of a hub, ``k`` chosen by hash: its others reach it by
    their own lists) and keep what beats a member's worst neighbour. With ``only`` (node) nothing is kept for other members."""
    if only is not None:  # other lists can bring their members nothing
        wanted = only.select("node")
        near = lists.join(wanted, lists["v"] == wanted["node"], "left_semi").select("u").union(wanted).distinct()
        lists = lists.join(near, "u", "left_semi")
    reverse = lists.select(F.col("v").alias("u"), F.col("u").alias("v"))
    some = F.row_number().over(Window.partitionBy("u").orderBy(F.xxhash64("u", "v"), "v"))
    reverse = reverse.withColumn("r", some).where(F.col("r") <= k).drop("r")
    own = lists.select("u", F.col("u").alias("v")).distinct()
    member = lists.select("u", "v").union(reverse).union(own).distinct()
    bars = lists.groupBy("u").agg(F.min("sim").alias("bar"), F.count("*").alias("have"))
    bars = bars.select(F.col("u").alias("v"), F.when(F.col("have") < k, -2.0).otherwise(F.col("bar")).alias("bar"))
    known = vectors.select(F.col("node").alias("v"), "x").join(bars, "v", "left")
    bar = F.coalesce("bar", F.lit(-2.0))
    if only is not None:
        known = known.join(only.select(F.col("node").alias("v"), F.lit(True).alias("wanted")), "v", "left")
        bar = F.when(F.col("wanted"), bar).otherwise(2.0)
    rows = member.join(known.withColumn("bar", bar), "v").select("u", "v", "x", "bar")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for part in parts:
            part = part if held is None else pd.concat([held, part], ignore_index=True)
            last = part["u"].iloc[-1] if len(part) else None
            held = part[part["u"] == last]
            whole = part[part["u"] != last]
            if len(whole):
                yield compare(whole)
        if held is not None and len(held):
            yield compare(held)

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        u, v, bar, x = part["u"].to_numpy(), part["v"].to_numpy(), part["bar"].to_numpy(), Rows(part["x"])
        cuts = np.flatnonzero(u[1:] != u[:-1]) + 1
        us, vs, sims = [], [], []
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(u)], strict=True):
            y = x[a:b]
            sim = y @ y.T
            np.fill_diagonal(sim, -3)
            i, j = np.nonzero(sim > bar[a:b, None])
            us.append(v[a:b][i])
            vs.append(v[a:b][j])
            sims.append(sim[i, j])
        return _top(np.concatenate(us), np.concatenate(vs), np.concatenate(sims), k)

    return rows.repartition("u").sortWithinPartitions("u").mapInPandas(run, _EDGES)


def _descend(vectors: DataFrame, lists: DataFrame | None, seed: int, k: int, rounds: int, trees: int = TREES) -> DataFrame:
    found = lists
    for t in range(trees):
        leaf = _leaf_edges(vectors, seed + t, k)
        found = leaf if found is None else found.union(leaf)
    now = settle(_best(found, k), "nn-lists")
    for _ in range(rounds):
        more = settle(_round(vectors, now.df, k), "nn-found")
        now = settle(_best(now.df.union(more.df), k), "nn-lists")
        # What was found anew beats a worst neighbour, so it counts the changes at least once.
        if more.rows <= STILL * now.rows:
            break
    return now.df


def _widened(vectors: DataFrame, lists: DataFrame, threshold: float) -> tuple[DataFrame, int]:
    """Lists twice as long for saturated nodes, whose lists reach the threshold to their ends, as long as there are such nodes
    and up to ``LONGEST``; and the length reached."""
    k = NEIGHBOURS
    while k < LONGEST:
        full = settle(_saturated(lists, k, threshold), "nn-saturated")
        if not full.rows:
            break
        k *= 2
        for _ in range(ROUNDS):
            more = settle(_round(vectors, lists, k, full.df), "nn-found")
            known = lists.withColumnRenamed("sim", "held")
            fresh = more.df.join(known, ["u", "v"], "left_anti")
            now = settle(_best(lists.union(fresh), k), "nn-lists")
            grown = now.rows - lists.count()
            lists = now.df
            if grown <= STILL * full.rows:
                break
    return lists, k


def _blocks(members: DataFrame, vectors: DataFrame, group: str) -> DataFrame:
    """(group, block, nodes, xs): vectors of a group in blocks of about ``BLOCK`` by hash."""
    sizes = members.groupBy(group).agg(F.count("*").alias("n"))
    held = members.join(sizes, group).join(vectors.select("node", "x"), "node")
    block = F.pmod(F.xxhash64("node"), F.ceil(F.col("n") / BLOCK).cast("long"))
    return held.withColumn("block", block).groupBy(group, "block").agg(
        F.sort_array(F.collect_list(F.struct("node", "x"))).alias("rows")
    ).select(group, "block", F.col("rows.node").alias("nodes"), F.col("rows.x").alias("xs"))


def _saturated(lists: DataFrame, k: int, threshold: float) -> DataFrame:
    """Nodes whose list is full and reaches the threshold to its end; any other node's list holds all its links."""
    ends = lists.groupBy("u").agg(F.count("*").alias("have"), F.min("sim").alias("worst"))
    return ends.where((F.col("have") >= k) & (F.col("worst") >= threshold)).select(F.col("u").alias("node"))


def _dealt(rows: DataFrame, size: int) -> DataFrame:
    """``rows`` of a label in parts of about ``size``, as (label, part, parts) beside their columns."""
    parts = rows.groupBy("label").agg(F.ceil(F.count("*") / size).cast("long").alias("parts"))
    place = F.pmod(F.xxhash64(*[c for c in rows.columns if c != "label" and c not in ("x", "radius")]), F.col("parts"))
    return rows.join(parts, "label").withColumn("part", place)


def _met(parts: DataFrame) -> DataFrame:
    """Every pair i <= j of a label's parts (label, part, parts, rows), as rows and others: a key of its own each."""
    upto = parts.select("label", F.col("part").alias("i"), "rows", F.explode(F.expr("sequence(part, parts - 1)")).alias("j"))
    down = parts.select("label", F.col("part").alias("j"), F.col("rows").alias("others"), F.explode(F.expr("sequence(0L, part)")).alias("i"))
    return upto.join(down, ["label", "i", "j"])


def _bridges(blocks: DataFrame, threshold: float) -> DataFrame:
    """(u, v): a link between any two blocks (label, c, block, nodes, xs) of different components that have one."""
    reach = float(np.arccos(threshold)) + 1e-5

    def ball(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                x = unpack(r.xs)
                centre = x.sum(axis=0)
                norm = np.linalg.norm(centre)
                centre = centre / norm if norm > 0 else x[0]
                radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
                yield pd.DataFrame({"label": [r.label], "c": [r.c], "block": [r.block], "x": [centre.astype("<f8").tobytes()], "radius": [radius]})

    def touch(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                a, b = (pd.DataFrame([(q["c"], q["block"], bytes(q["x"]), q["radius"]) for q in t], columns=["c", "block", "x", "radius"]) for t in (r.rows, r.others))
                x, y = (np.stack([np.frombuffer(v, dtype="<f8") for v in t["x"]]) for t in (a, b))
                apart = np.arccos(np.clip(x @ y.T, -1, 1)) - a["radius"].to_numpy()[:, None] - b["radius"].to_numpy()[None]
                near = (apart <= reach) & (a["c"].to_numpy()[:, None] != b["c"].to_numpy()[None])
                i, j = np.nonzero(near)
                yield pd.DataFrame(
                    {"c": a["c"].to_numpy()[i], "block": a["block"].to_numpy()[i], "c2": b["c"].to_numpy()[j], "block2": b["block"].to_numpy()[j]}
                )

    def link(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                hit = unpack(r.xs) @ unpack(r.ys).T >= threshold
                if hit.any():
                    i, j = np.unravel_index(hit.argmax(), hit.shape)
                    yield pd.DataFrame({"u": [r.nodes[i]], "v": [r.others[j]]})

    balls = blocks.mapInPandas(ball, "label long, c long, block long, x binary, radius double")
    parts = _dealt(settle(balls, "nn-balls").df, 2 * BLOCK).groupBy("label", "part", "parts").agg(
        F.collect_list(F.struct("c", "block", "x", "radius")).alias("rows")
    )
    near = settle(_met(parts).mapInPandas(touch, "c long, block long, c2 long, block2 long").distinct(), "nn-touching").df
    other = blocks.select(F.col("c").alias("c2"), F.col("block").alias("block2"), F.col("nodes").alias("others"), F.col("xs").alias("ys"))
    met = near.join(blocks.select("c", "block", "nodes", "xs"), ["c", "block"]).join(other, ["c2", "block2"])
    return met.select("nodes", "xs", "others", "ys").mapInPandas(link, "u long, v long")


def _joined(lists: DataFrame, vectors: DataFrame, threshold: float, k: int) -> DataFrame:
    """(node, component) by the links of the lists and those between saturated nodes of different components."""
    links = lists.where(F.col("sim") >= threshold).select("u", "v")
    joined = settle(components(links, "nn-components"), "nn-joined").df
    full = settle(joined.join(_saturated(lists, k, threshold), "node").select("node", F.col("component").alias("c")), "nn-saturated")
    if not full.rows:
        return joined
    labels = full.df.join(vectors.select("node", "label"), "node").groupBy("c").agg(F.first("label").alias("label"))
    blocks = settle(_blocks(full.df, vectors, "c").join(labels, "c"), "nn-saturated-blocks").df
    bridges = settle(_bridges(blocks, threshold), "nn-bridges")
    if not bridges.rows:
        return joined
    return settle(components(links.union(bridges.df), "nn-components"), "nn-joined").df


def _block_links(pairs: DataFrame, threshold: float) -> DataFrame:
    """Counts of links and the smallest partner per node for block pairs (nodes, xs, w: weights, other...)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                x, y = unpack(r.xs), unpack(r.ys)
                hit = x @ y.T >= threshold
                hit &= r.nodes[:, None] != r.others[None, :]
                some = hit.any(axis=1)
                partner = r.others[hit.argmax(axis=1)]
                n = hit @ np.asarray(r.weights, dtype=np.int64)
                yield pd.DataFrame({"node": r.nodes[some], "n": n[some], "partner": partner[some]})

    return pairs.mapInPandas(run, "node long, n long, partner long")


def _truth(vectors: DataFrame, nodes: DataFrame, asked: DataFrame, threshold: float) -> pd.DataFrame:
    """(node, truth) of the nodes ``asked`` that have links, by brute force in blocks."""
    rows = asked.collect()
    ids, labels = np.array([r.node for r in rows]), np.array([r.label for r in rows])
    xs = [bytes(r.x) for r in rows]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(ids), dtype=np.int64)
        for part in parts:
            size = part["x"].map(len).to_numpy()
            for a in range(0, len(ids), BLOCK):
                # A label has one vector length; a batch and the nodes asked may hold several.
                for length in set(map(len, xs[a : a + BLOCK])) & set(size.tolist()):
                    mine = a + np.flatnonzero([len(v) == length for v in xs[a : a + BLOCK]])
                    theirs = part[size == length]
                    hit = unpack([xs[i] for i in mine]) @ unpack(theirs["x"]).T >= threshold
                    hit &= labels[mine][:, None] == theirs["label"].to_numpy()[None, :]
                    hit &= ids[mine][:, None] != theirs["node"].to_numpy()[None, :]
                    total[mine] += hit @ theirs["k"].to_numpy()
        yield pd.DataFrame({"node": ids, "n": total})

    all_ = vectors.join(nodes.select("node", "k"), "node").mapInPandas(run, "node long, n long")
    return all_.groupBy("node").agg(F.sum("n").alias("truth")).where("truth > 0").toPandas()


def _sample(vectors: DataFrame, nodes: DataFrame, threshold: float) -> pd.DataFrame:
    """Links of audited nodes, the first by hash: as many as the root of the rows, and four times as many again while fewer
    than ``LINKED`` of them have links, within ``AUDIT_BYTES``."""
    rows, longest = vectors.agg(F.count("*"), F.max(F.octet_length("x"))).first()
    most = max(AUDIT, AUDIT_BYTES // (longest or 1))
    size = min(max(AUDIT, math.isqrt(rows)), most)
    while True:
        truth = _truth(vectors, nodes, vectors.orderBy(F.xxhash64("node"), "node").limit(size), threshold)
        if len(truth) >= LINKED or size >= min(rows, most):
            return truth
        size = min(4 * size, most)


def _audit(truth: pd.DataFrame, counts: DataFrame) -> float:
    """Mean share of a node's links that are in ``counts``, in the class of link counts (by powers of two) where it is least."""
    if not len(truth):
        return 1.0
    asked = counts.sparkSession.createDataFrame(truth[["node", "truth"]])
    met = counts.select("node", "n").join(F.broadcast(asked), "node").toPandas().set_index("node")["n"]
    share = np.minimum(truth["node"].map(met).fillna(0) / truth["truth"], 1.0)
    return float(share.groupby(np.log2(truth["truth"]).astype(int)).mean().min())


def _exact(vectors: DataFrame, nodes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Components and link counts from all pairs of a label, block against block."""

    def link(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for r in part.itertuples(index=False):
                a, b = (np.array([q["node"] for q in t]) for t in (r.rows, r.others))
                x, y = (unpack([bytes(q["x"]) for q in t]) for t in (r.rows, r.others))
                k, m = (np.array([q["k"] for q in t]) for t in (r.rows, r.others))
                hit = (x @ y.T >= threshold) & (a[:, None] != b[None])
                sides = [(a, hit, m)] if r.i == r.j else [(a, hit, m), (b, hit.T, k)]
                # A star to the least node of each component inside the two blocks keeps what hangs together.
                least = [a.copy(), b.copy()]
                while True:
                    big = np.iinfo(np.int64).max
                    left = np.minimum(least[0], np.where(hit, least[1][None], big).min(axis=1))
                    right = np.minimum(least[1], np.where(hit, left[:, None], big).min(axis=0))
                    same = (left == least[0]).all() and (right == least[1]).all()
                    least = [left, right]
                    if same:
                        break
                for (own, met, weight), star in zip(sides, least, strict=False):
                    some = met.any(axis=1)
                    yield pd.DataFrame({"node": own[some], "n": (met @ weight)[some], "partner": star[some]})

    rows = vectors.join(nodes.select("node", "k"), "node").select("label", "node", "k", F.col("x"))
    parts = _dealt(rows, 2 * BLOCK).groupBy("label", "part", "parts").agg(F.collect_list(F.struct("node", "k", "x")).alias("rows"))
    found = settle(_met(settle(parts, "nn-exact-blocks").df).mapInPandas(link, "node long, n long, partner long"), "nn-exact").df
    joined = settle(components(found.select("node", "partner"), "nn-components"), "nn-joined").df
    return joined, settle(found.groupBy("node").agg(F.sum("n").alias("n")), "nn-counts").df


def near_duplicates(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98
) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``df``.

    Vectors that are null, zero or hold null or non-finite components, and those without label or id, link with nothing and
    are kept as their own component. Repeated rows with one id are copies of one another and count as links. Vectors of
    different lengths are never compared, whatever their label. An empty table gives an empty result.
    """
    label, vector = F.col(f"`{label_col}`").cast("long"), F.col(f"`{vector_col}`")
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.alias("label"), vector.alias("x"))
    fit = usable(F.col("x")) & F.col("label").isNotNull() & F.col("id").isNotNull()
    named = rows.withColumn("h", F.when(fit, F.xxhash64("label", "x"))).withColumn("h2", F.when(fit, F.xxhash64("x", "label", F.lit(7))))
    groups = named.where(fit).groupBy("h", "h2").agg(F.min(F.struct("id", "label", "x")).alias("r"), F.count("*").alias("k"))
    groups = groups.select("h", "h2", "k", F.col("r.id").alias("id"), F.col("r.label").alias("label"), F.col("r.x").alias("x"))
    nodes = settle(groups.withColumn("node", F.col("h")), "nn-nodes").df
    # Lengths are kept apart by giving each its own label.
    apart = F.xxhash64("label", F.size("x"))
    vectors = settle(_vectors(nodes.select("node", apart.alias("label"), "x")), "nn-vectors").df
    truth = _sample(vectors, nodes, threshold)
    lists, trees, reached, seed = None, TREES, -1.0, 17
    while True:
        if not len(truth):  # no audited node has a link, so descent could not be measured
            joined, counts = _exact(vectors, nodes, threshold)
            break
        lists = _descend(vectors, lists, seed, NEIGHBOURS, ROUNDS, trees)
        lists, longest = _widened(vectors, lists, threshold)
        joined = _joined(lists, vectors, threshold, longest)
        blocks = settle(_blocks(joined.withColumnRenamed("component", "c"), vectors, "c"), "nn-blocks").df
        weights = nodes.select("node", "k")
        weighed = blocks.select("c", "block", F.posexplode("nodes").alias("i", "node")).join(weights, "node")
        weighed = weighed.groupBy("c", "block").agg(F.sort_array(F.collect_list(F.struct("i", "k"))).alias("w"))
        # Every pair of a component's blocks is a key of its own, so a large component is many small tasks.
        parts = blocks.groupBy("c").agg((F.max("block") + 1).alias("parts"))
        every = F.explode(F.expr("sequence(0L, parts - 1)"))
        one = blocks.join(parts, "c").select("c", F.col("block").alias("i"), "nodes", "xs", every.alias("j"))
        other = blocks.join(weighed, ["c", "block"]).join(parts, "c").select(
            "c", F.col("block").alias("j"), F.col("nodes").alias("others"), F.col("xs").alias("ys"), F.col("w.k").alias("weights"), every.alias("i")
        )
        met = one.join(other, ["c", "i", "j"])
        counts = _block_links(met, threshold).groupBy("node").agg(F.sum("n").alias("n"))
        counts = settle(counts, "nn-counts").df
        recall = _audit(truth, counts)
        if recall >= RECALL:
            break
        if recall <= reached:
            joined, counts = _exact(vectors, nodes, threshold)
            break
        reached, seed, trees = recall, seed + trees, 2 * trees
    placed = nodes.select("h", "h2", "node", "k", "id").join(joined, "node", "left").join(counts, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    least = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    placed = placed.join(least, "component").select("h", "h2", "component_id", (F.coalesce("n", F.lit(0)) + F.col("k") - 1).alias("links"))
    component = F.coalesce("component_id", "id")
    return named.join(placed, ["h", "h2"], "left").select(
        F.col("id").alias(id_col),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )

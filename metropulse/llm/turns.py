"""Repair of conversations with the fewest edits: a dynamic program with square-root checkpoints.

A row's fault is blank, duplicate (role and text seen earlier in the conversation) or truncated. Keep costs 0, Rerole to user or
assistant 1, Delete 2, Insert of an empty-text user or assistant row 5; truncated rows that stay add 5, blank and duplicate ones must
go. The initials of the roles must end as ``(s?(ua)+)?``, which a machine of four states reads: nothing yet, after s, after u, after a.
The cost of the rest is a vector of four numbers for each row, from the last row backwards.

Rows are laid in ranges of (conversation, turn, role, text) and numbered; each task takes a segment of at most ``2 ** SEGMENT_BITS``
rows. Nearly all conversations lie in one segment. One that spans several first gives each segment's 4 x 4 matrix of least costs, from
which the cost vectors at its segments' ends follow; each segment is then walked from all four states, and the walks that fit together
are chosen. Inside a segment vectors are stored only at every sqrt(n)-th row and the blocks between are computed again while walking
forward, always taking the ASCII-least tight edit.

Equal rows of a conversation (turn, role and text) travel as one row with ``copies``, for all but the first are duplicates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metropulse.operators.staging import join_sized, settle

SEGMENT_BITS = 17
#: Signs of a text that ranges are cut by; longer common beginnings stay in one range.
RANGE_SIGNS = 64

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an inserted or reroled row leads from each state, and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: (state, initial) -> state of a kept row.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Cost after the last row: nothing and an assistant's row may end a conversation, the others need insertions.
LAST = (0, 2 * INSERT, INSERT, 0)
LEGAL = {"su", "ua", "au"}
STATES = range(4)

#: Space and 0x09-0x0D, as in the words of the other operators.
_GAP = " \\t-\\r"


def _step(row: tuple[str, str, int], after: list[int]) -> list[int]:
    """Least costs from each state before a row, given those after it. A row is (initial, fault, copies)."""
    initial, fault, copies = row
    out = [DELETE + v for v in after]
    if fault not in ("blank", "duplicate"):
        stays = TRUNCATED if fault == "truncated" else 0
        for s in STATES:
            out[s] = min(out[s], RETYPE + stays + after[NEXT[s]])
            if (to := KEPT.get((s, initial))) is not None:
                out[s] = min(out[s], stays + after[to])
    user, assistant = out[USER], out[ASSISTANT]
    out[USER] = min(user, INSERT + assistant)
    out[ASSISTANT] = min(assistant, INSERT + user)
    out[START] = min(out[START], INSERT + out[USER])
    out[SYSTEM] = min(out[SYSTEM], INSERT + out[USER])
    more = DELETE * (copies - 1)
    return [v + more for v in out]


def _edits(row: tuple[str, str, int], here: list[int], after: list[int], state: int) -> tuple[str, str, int]:
    """The ASCII-least tight edits of a row (without those of its further copies), the initials they make (- for a deleted row) and
    the state they lead to."""
    initial, fault, copies = row
    stays = TRUNCATED if fault == "truncated" else 0
    more = DELETE * (copies - 1)
    edits = made = ""
    while True:
        left = here[state] - more
        if left == DELETE + after[state]:
            return edits + "D", made + "-", state
        if left == INSERT + here[NEXT[state]] - more:
            state = NEXT[state]
            edits, made = edits + "I", made + "--ua"[state]
            continue
        to = KEPT.get((state, initial))
        if to is not None and left == stays + after[to]:
            return edits + "K", made + initial, to
        state = NEXT[state]
        return edits + "R", made + "--ua"[state], state


def _tail(state: int) -> tuple[str, str]:
    """The insertions after the last row."""
    made = ""
    while LAST[state]:
        state = NEXT[state]
        made += "--ua"[state]
    return "I" * len(made), made


def walk(rows: list[tuple[str, str, int]], end: list[int], states: list[int]) -> tuple[list[list[tuple[str, str]]], list[int]]:
    """For each of ``states`` before the first row the edits and made initials of every row and the state after the last, given
    the costs ``end`` after it. Vectors are held for about 2 sqrt(n) rows at a time."""
    n = len(rows)
    size = isqrt(max(n - 1, 0)) + 1
    checkpoints, vector = {n: list(end)}, list(end)
    for i in range(n - 1, -1, -1):
        vector = _step(rows[i], vector)
        if i % size == 0:
            checkpoints[i] = vector
    out: list[list[tuple[str, str]]] = [[] for _ in states]
    now = list(states)
    for first in range(0, n, size):
        last = min(first + size, n)
        block = [checkpoints[last]]
        for i in range(last - 1, first - 1, -1):
            block.append(_step(rows[i], block[-1]))
        block.reverse()
        for k in range(len(states)):
            for i in range(first, last):
                edits, made, now[k] = _edits(rows[i], block[i - first], block[i - first + 1], now[k])
                out[k].append((edits, made))
    return out, now


def cost_matrix(rows: list[tuple[str, str, int]]) -> list[int]:
    """Least costs from each state before the rows (row of the matrix) to each after them."""
    columns = []
    for s in STATES:
        vector = [0 if t == s else FAR for t in STATES]
        for row in reversed(rows):
            vector = [min(v, FAR) for v in _step(row, vector)]
        columns.append(vector)
    return [columns[t][s] for s in STATES for t in STATES]


def _conversations(part: pd.DataFrame) -> Iterator[tuple[str | None, pd.DataFrame, list[tuple[str, str, int]]]]:
    part = part.sort_values("at", ignore_index=True)
    keys = part["conv"].tolist()
    rows = list(zip(part["initial"].tolist(), part["fault"].tolist(), part["copies"].tolist(), strict=True))
    first = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[first]:
            yield keys[first], part["at"].iloc[first:i], rows[first:i]
            first = i


def _matrices(part: pd.DataFrame) -> pd.DataFrame:
    """Cost matrices of a segment's first and last conversation, the only ones that other segments can share."""
    found = list(_conversations(part))
    shared = [found[0], found[-1]] if len(found) > 1 else found
    segment = int(part["segment"].iloc[0])
    return pd.DataFrame([(key, segment, cost_matrix(rows)) for key, _, rows in shared], columns=["conv", "segment", "costs"])


def _ends(part: pd.DataFrame) -> pd.DataFrame:
    """For a conversation of several segments the costs after each; nothing for the others."""
    part = part.sort_values("segment", ignore_index=True)
    out, vector = [], list(LAST)
    if len(part) > 1:
        for i in range(len(part) - 1, -1, -1):
            out.append((part["conv"].iloc[i], int(part["segment"].iloc[i]), vector, i == 0, i == len(part) - 1))
            m = part["costs"].iloc[i]
            vector = [min(int(m[4 * s + t]) + vector[t] for t in STATES) for s in STATES]
    return pd.DataFrame(out, columns=["conv", "segment", "ends", "opens", "closes"])


_WALKED = "at long, conv string, segment long, entry int, leaves int, spans boolean, edits string, made string, tail string"


def _walks(part: pd.DataFrame, spans: pd.DataFrame) -> pd.DataFrame:
    """Edits of a segment's rows. A conversation that began in an earlier segment is walked from all states."""
    spanning = {r.conv: r for r in spans.itertuples()}
    segment = int(part["segment"].iloc[0]) if len(part) else 0
    out = []
    for key, at, rows in _conversations(part):
        span = spanning.get(key)
        entries = [START] if span is None or span.opens else list(STATES)
        end = list(LAST) if span is None else [int(v) for v in span.ends]
        walked, leaves = walk(rows, end, entries)
        for entry, edits, state in zip(entries, walked, leaves, strict=True):
            tail = _tail(state) if span is None or span.closes else ("", "")
            for i, (number, (edit, made)) in enumerate(zip(at.tolist(), edits, strict=True)):
                after, more = tail if i == len(edits) - 1 else ("", "")
                out.append((number, key, segment, entry, state, span is not None, edit, made + more, after))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _WALKED.split(", ")])


def _chosen(part: pd.DataFrame) -> pd.DataFrame:
    """Of a conversation's walks those that begin where the walk of the segment before ended."""
    state, out = START, []
    for segment, walks in part.sort_values("segment").groupby("segment"):
        out.append((part["conv"].iloc[0], int(segment), state, True))
        state = int(walks.loc[walks["entry"] == state, "leaves"].iloc[0])
    return pd.DataFrame(out, columns=["conv", "segment", "entry", "chosen"])


def plan(turns: DataFrame) -> DataFrame:
    """The rows of ``turns`` (conv_id, turn, role, text, and copies if a row stands for several) in order with their faults and edits:
    at (rising with conversation and turn), copies, fault (of the first copy), edits (letters of the first copy with
    insertions before it; further copies are deleted), tail (insertions after a conversation's last row) and made (initials of the
    rows that stand for edits and tail, - for a deleted one).

    Rows are taken by turn, null turns first, then role and text. Null conversation ids are one conversation; null roles and texts
    count as one space. Other columns are left out. An empty table gives no rows. A frequent conversation is spread over
    ranges and segments; only one that spans segments is walked from four states.
    """
    named = turns.columns
    copies = F.col("copies").cast("long") if "copies" in named else F.lit(1).cast("long")
    rows = turns.select(
        F.col("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        copies.alias("copies"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    begun = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn")]
    laid = rows.repartitionByRange(*begun, "role", F.substring("text", 1, RANGE_SIGNS))
    laid = laid.sortWithinPartitions(*begun, "role", "text").withColumn("at", F.monotonically_increasing_id())
    ordered = settle(laid, "turns").df

    first = ordered.groupBy("conv_id", "role", "text").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    text = F.col("text")
    fault = F.when(~text.rlike(f"[^{_GAP}]"), "blank").when(F.col("first").isNull(), "duplicate")
    fault = fault.when(~text.rlike(f"[.!?][{_GAP}]*\\z"), "truncated").otherwise("")
    marked = ordered.join(first, "at", "left").select(
        "at",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
        F.substring("role", 1, 1).alias("initial"),
        fault.alias("fault"),
        "copies",
        F.shiftright("at", SEGMENT_BITS).alias("segment"),
    )
    slim = settle(marked, "turn-faults").df
    matrices = slim.groupBy("segment").applyInPandas(_matrices, "conv string, segment long, costs array<long>")
    spans = matrices.groupBy("conv").applyInPandas(
        _ends, "conv string, segment long, ends array<long>, opens boolean, closes boolean"
    )
    spans = settle(spans, "turn-spans").df
    walked = slim.groupBy("segment").cogroup(spans.groupBy("segment")).applyInPandas(_walks, _WALKED)
    walked = settle(walked, "turn-walks").df
    # Two rows per segment and state at most.
    several = walked.where("spans").select("conv", "segment", "entry", "leaves").distinct()
    chosen = several.groupBy("conv").applyInPandas(_chosen, "conv string, segment long, entry int, chosen boolean")
    kept = join_sized(walked, chosen, ["conv", "segment", "entry"], label="turn-choice")
    kept = kept.where("not spans or chosen").select("at", "edits", "made", "tail")
    faults = slim.select("at", "fault")
    return ordered.join(faults.join(kept, "at"), "at")


def repaired_rows(planned: DataFrame) -> DataFrame:
    """(conv_id, at, nth, role, text, edit) of the repaired conversations, in order of at and nth."""
    letters = F.concat("edits", "tail")
    parts = F.transform(
        F.sequence(F.lit(1), F.length(letters)),
        lambda i: F.struct(i.alias("nth"), F.substring(letters, i, F.lit(1)).alias("edit"), F.substring("made", i, F.lit(1)).alias("initial")),
    )
    each = planned.select("conv_id", "at", "role", "text", F.explode(parts).alias("p")).where("p.edit <> 'D'")
    role = F.when(F.col("p.edit") == "K", F.col("role")).when(F.col("p.initial") == "u", "user").otherwise("assistant")
    body = F.when(F.col("p.edit") == "I", "").otherwise(F.col("text"))
    return each.select("conv_id", "at", "p.nth", role.alias("role"), body.alias("text"), "p.edit")


class _Report:
    """Running sums of one conversation."""

    def __init__(self, conv):
        self.conv, self.initial, self.audit, self.sha, self.lines = conv, None, [], hashlib.sha256(), 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0

    def line(self, role: str, text: str) -> None:
        self.sha.update((b"\n" if self.lines else b"") + f"{role}:{text}".encode())
        self.lines += 1

    def add(self, role, text, copies, fault, edits, made, tail) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL:
            self.illegal += 1
        self.illegal += copies - 1  # a role next to itself
        self.initial = initial
        if fault == "blank":
            self.blank += copies
        else:
            self.duplicate += copies - 1 + (fault == "duplicate")
            self.truncated += fault == "truncated"
        for edit, sign in zip(edits + tail, made, strict=True):
            if edit == "I":
                self.line("user" if sign == "u" else "assistant", "")
            elif edit != "D":
                self.line(role if edit == "K" else "user" if sign == "u" else "assistant", text)
                self.cost += TRUNCATED if fault == "truncated" else 0
            self.cost += {"I": INSERT, "R": RETYPE, "D": DELETE, "K": 0}[edit]
        self.cost += DELETE * (copies - 1)
        self.audit += [edits, "D" * (copies - 1), tail]

    def row(self) -> tuple:
        audit = "".join(self.audit)
        return (self.conv, self.blank, self.duplicate, self.truncated, self.illegal, self.cost, audit, self.sha.hexdigest())


_COUNTS = ["blank", "duplicate", "truncated", "illegal", "cost"]


def report(planned: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    A hash of a whole conversation is made row after row, so a conversation's rows stream through one task in order; it holds an Arrow
    batch and the audit, which is a letter per row.
    """
    kind = planned.schema["conv_id"].dataType
    names = ["role", "text", "copies", "fault", "edits", "made", "tail"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, done = None, []
        kinds = None
        for batch in batches:
            kinds = [batch.schema.field(0).type, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
            columns = [c.to_pylist() for c in batch.columns]
            for conv, *row in zip(*columns, strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Report(conv)
                now.add(*row)
            if len(done) >= 1000:
                yield _batch(done, kinds)
                done = []
        if now is not None:
            yield _batch([*done, now.row()], kinds)

    def _batch(rows, kinds):
        arrays = [pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["conv_id", *_COUNTS, "audit", "repaired_sha256"])

    order = [F.col("conv_id").asc_nulls_first(), F.col("at")]
    stream = planned.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", *names)
    made = ", ".join([f"conv_id {kind.simpleString()}", *[f"{c} long" for c in _COUNTS], "audit string, repaired_sha256 string"])
    told = stream.mapInArrow(run, made)
    by_turn = planned.groupBy("conv_id", "turn").agg(F.count("*"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    gaps = by_turn.groupBy(F.col("conv_id").alias("gap_id")).agg(F.coalesce(span, F.lit(0)).alias("gaps"))
    return told.join(gaps, F.col("conv_id").eqNullSafe(F.col("gap_id"))).drop("gap_id")


def repair(turns: DataFrame) -> DataFrame:
    """``report`` of the edits that ``plan`` gives, settled in between."""
    return report(settle(plan(turns), "turn-plan").df)


def damaged(table: DataFrame) -> DataFrame:
    """Conversations with planted faults, by a hash of conversation and turn (nulls: one space): rows dropped, emptied, without
    sentence ends, twice, or with the role user."""
    known = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    h = F.crc32(F.concat(known[0], F.lit(":"), known[1])) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    return table.where(h != 0).select(
        "conv_id",
        "turn",
        F.when(h == 4, "user").otherwise(role).alias("role"),
        F.when(h == 1, "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 3, 2).otherwise(1).alias("copies"),
    )


def with_all(table: DataFrame, reported: DataFrame) -> DataFrame:
    """The report with a row for every conversation of ``table``; those without rows have zeros and an empty audit."""
    every = table.groupBy(F.col("conv_id").alias("every_id")).agg(F.count("*").alias("n")).drop("n")
    joined = every.join(reported, F.col("every_id").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256().hexdigest()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_COUNTS)]
    texts = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256")]
    return joined.select(F.col("every_id").alias("conv_id"), *counts, *texts)

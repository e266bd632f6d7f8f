"""Runs of repeated words, repaired conversations and token files against brute force."""

import hashlib
import heapq
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from metropulse.llm import periodic, registry, token_files, turns
from metropulse.operators.staging import settle, shared_folder

VOCABULARY = f"{registry.TOKENIZERS}/byte_bpe_50k.json"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, id long, start long"


def docs_of(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, 2, 3) for i, t in texts], DOCS)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- runs ----------------------------------------------------------------------------------------------------------------


def brute_runs(words):
    out = set()
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            smaller = any(all(words[k] == words[k + r] for k in range(s, e - r)) for r in range(1, q))
            if e - s >= max(24, 3 * q) and not smaller:
                out.add((s, e - s, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    words = []
    for _ in range(rng.randint(0, 8)):
        kind = rng.random()
        if kind < 0.3:
            words += [rng.randrange(50) for _ in range(rng.randint(0, 40))]
        elif kind < 0.6:
            pattern = [rng.randrange(rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(1, 40))]
            words += [pattern[i % len(pattern)] for i in range(rng.randint(1, 150))]
        else:
            words += [rng.randrange(2) for _ in range(rng.randint(0, 60))]
    return words


def test_runs_equal_brute_force():
    rng = random.Random(1)
    for _ in range(150):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 6))]
        ids = np.array([x for w in texts for x in w], dtype=np.int64)
        at = np.append(0, np.cumsum([len(w) for w in texts]))
        expected = [[i, *r] for i, w in enumerate(texts) for r in brute_runs(w)]
        assert periodic.find_runs(ids, at).tolist() == expected


def test_transform_of_squared_differences_is_exact():
    rng = np.random.default_rng(2)
    for size in (8, 16, 64):
        blocks, windows = (rng.integers(0, periodic.PRIME, (5, n)).astype(np.uint64) for n in (size, 2 * size - 1))
        windows[0, 3 : 3 + size] = blocks[0]
        got = periodic.mismatch(blocks, windows)
        for r in range(5):
            for d in range(size):
                exact = sum((int(a) - int(b)) ** 2 for a, b in zip(blocks[r], windows[r, d : d + size], strict=True))
                assert int(got[r, d]) == exact % periodic.PRIME
        assert got[0, 3] == 0


def test_runs_of_a_long_text_stay_quick():
    for ids in (np.zeros(200_000), np.arange(200_000) % 50_000, np.arange(200_000) % 9):
        runs = periodic.find_runs(ids.astype(np.int64), np.array([0, 200_000]))
        assert runs.tolist() == [[0, 0, 200_000, int(ids.max()) + 1]]


def test_periodic_runs_of_tables(spark):
    again = " ".join(["one two\tthree"] * 10)
    texts = [(1, None), (2, ""), (3, " \n "), (4, again), (4, again), (None, "x " * 30), (5, "é b"), (6, "z " * 20 + "Z z " * 20)]
    got = periodic.periodic_runs(docs_of(spark, texts), keep=["doc_id", "id", "start"]).collect()
    assert len(got) == len(texts) and {r.start for r in got} == {3}
    by_id = {r.doc_id: r for r in got}
    for i, text in texts:
        words = (text or "").split()
        runs = brute_runs(words)
        assert [tuple(r) for r in by_id[i].runs] == runs and by_id[i].n_words == len(words)
        assert by_id[i].collapsed == brute_collapsed(words, runs)
    assert periodic.periodic_runs(docs_of(spark, texts).limit(0), keep=["doc_id"]).count() == 0
    with pytest.raises(ValueError, match="n_words"):
        periodic.periodic_runs(docs_of(spark, texts), keep=["n_words"])


def expected_runs(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a, p = g % n, 0
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), *told, sha(lines), sha(brute_collapsed(words, runs)))


def write_table(spark, name, df):
    folder = shared_folder(spark, "tables")
    df.write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_op11_equals_brute_force(spark):
    rng = random.Random(3)
    texts = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(rng.choice([0, 1, 2, 30, 120, 300])))) for i in range(150)]
    texts += [(1000 + i, " ".join(map(str, repetitive(rng)))) for i in range(60)] + [(5000, None), (None, "a " * 40), (7, texts[7][1])]
    folder = write_table(spark, "documents", docs_of(spark, texts))
    found = registry.op11_periodic_runs(spark, folder)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert found.columns == names and [t for _, t in found.dtypes] == ["bigint"] * 6 + ["string"] * 2
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted((expected_runs(*t) for t in texts), key=key)


# --- conversations ---------------------------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, at long, copies_of string"


def cheapest(rows):
    """(cost, audit, repaired) of the ASCII-least cheapest edits by search over (cost, audit) in order."""
    legal = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    ahead = {"": "u", "s": "u", "a": "u", "u": "a"}
    full = {"u": "user", "a": "assistant"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, audit, made
        if (i, state) in seen:
            continue
        seen.add((i, state))
        heapq.heappush(heap, (cost + 5, audit + "I", i, ahead[state], (*made, f"{full[ahead[state]]}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, made))
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                to = ahead[state]
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, to, (*made, f"{full[to]}:{text}")))
                if (state, role[:1]) in legal:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, legal[state, role[:1]], (*made, f"{role}:{text}")))
    return None


def expected_repairs(rows):
    gap = " \t\n\x0b\x0c\r"
    told = {}
    for conv in {r[0] for r in rows}:
        mine = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            role, text = role if role is not None else " ", text if text is not None else " "
            h = zlib.crc32(key.encode()) % 20
            if h == 0:
                continue
            text = "" if h == 1 else "".join(c for c in text if c not in ".!?") if h == 2 else text
            mine += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults = set(), []
        for _, role, text in mine:
            body = text.strip(gap)
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
        known = [t for t, _, _ in mine if t is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        cost, audit, made = cheapest([(r, t, f) for (_, r, t), f in zip(mine, faults, strict=True)])
        counts = [faults.count(k) for k in ("blank", "duplicate", "truncated")]
        told[conv] = (conv, gaps, *counts, illegal, cost, audit, sha("\n".join(made)))
    return told


def talk(rng, convs, longest):
    texts = ["Yes.", "no", "Why? ", " ", "", "Oh!\n", "a. b", None, "Nein.", "é.", "long " * 40 + "."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for c in convs:
        steps = rng.randint(0, longest)
        plain = rng.random() < 0.5
        for t in range(steps):
            role = ["user", "assistant"][t % 2] if plain and rng.random() < 0.8 else rng.choice(roles)
            turn = None if rng.random() < 0.05 else t if rng.random() < 0.8 else rng.randrange(steps)
            rows.append((c, turn, role, f"text {rng.randrange(60)}." if rng.random() < 0.6 else rng.choice(texts)))
    return rows + rows[:3]


@pytest.mark.parametrize("bits", [17, 3])
def test_op12_equals_brute_force(spark, monkeypatch, bits):
    """With 3 bits a segment has 8 rows, so conversations span many."""
    monkeypatch.setattr(turns, "SEGMENT_BITS", bits)
    rng = random.Random(bits)
    rows = talk(rng, [*range(40), None], 14) + talk(rng, [777, 778], 250)
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], TURNS).repartition(5)
    folder = write_table(spark, "conversations", table)
    found = registry.op12_conversation_repair(spark, folder)
    names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert found.columns == names and [t for _, t in found.dtypes] == ["bigint"] * 7 + ["string"] * 2
    got = {r.conv_id: tuple(r) for r in found.collect()}
    assert got == expected_repairs(rows)


def test_repair_without_rows_and_repaired_rows(spark):
    empty = spark.createDataFrame([], TURNS)
    assert turns.repair(empty).count() == 0 and turns.with_all(empty, turns.repair(turns.damaged(empty))).count() == 0
    rows = [(1, 0, "system", "Be kind.", 9, "x"), (1, 1, "assistant", "Hello.", 9, "x"), (1, 3, "user", " ", 9, "x"), (2, 1, "user", "Hm", 9, "x")]
    planned = settle(turns.plan(spark.createDataFrame(rows, TURNS)), "t").df
    made = turns.repaired_rows(planned).orderBy("conv_id", "at", "nth").select("conv_id", "role", "text", "edit").collect()
    assert [tuple(r) for r in made] == [(1, "user", "Be kind.", "R"), (1, "assistant", "Hello.", "K")]
    reported = {r.conv_id: (r.cost, r.audit, r.gaps) for r in turns.report(planned).collect()}
    assert reported == {1: (3, "RKD", 1), 2: (2, "D", 0)}


def test_walk_matches_search_on_long_conversations():
    rng = random.Random(9)
    for n in (0, 1, 2, 7, 100, 333):
        rows = [(rng.choice("suax"), rng.choice(["", "", "blank", "duplicate", "truncated"]), 1) for _ in range(n)]
        (edits,), (state,) = turns.walk(rows, list(turns.LAST), [turns.START])
        audit = "".join(e for e, _ in edits) + turns._tail(state)[0]
        assert audit == cheapest([(r, "t", f) for r, f, _ in rows])[1]


# --- token files -------------------------------------------------------------------------------------------------------------


def opened(data):
    return token_files.TokenFile(lambda offset, n: data[offset : offset + n], len(data))


@pytest.mark.parametrize(("n", "top"), [(0, 5), (1, 1), (1000, 2), (70_000, 50_257), (30_000, 2**32 - 1), (600, 300)])
def test_any_token_is_read_alone(n, top):
    rng = np.random.default_rng(n)
    ids = (rng.random(n) ** 3 * top).astype(np.uint32)
    data = token_files.encode_file([1, None], ids, np.array([0, n // 3, n]))
    file = opened(data)
    file.check()
    docs, bounds = file.documents()
    assert docs == [1, None] and bounds.tolist() == [0, n // 3, n]
    assert (file.stretch(0, n) == ids).all()
    for i in rng.integers(0, n, 100 if n else 0).tolist():
        j = int(rng.integers(i, n)) + 1
        assert file.token(i) == ids[i] and (file.stretch(i, j) == ids[i:j]).all()
    with pytest.raises(IndexError):
        file.token(n)


def test_one_token_reads_little():
    ids = (np.random.default_rng(1).random(500_000) ** 12 * 50_000).astype(np.uint32)
    data, read = token_files.encode_file([1], ids, np.array([0, len(ids)])), []
    file = token_files.TokenFile(lambda offset, n: read.append(n) or data[offset : offset + n], len(data))
    assert len(file.levels) > 1
    read.clear()
    assert file.token(int(ids.argmax())) == ids.max() and sum(read) < 400


def test_damaged_files_are_refused():
    ids = np.arange(1000, dtype=np.uint32)
    data = token_files.encode_file([1], ids, np.array([0, 1000]))
    for bad in (data[:-1], data[:40], b"XXXX" + data[4:], data + b"\0"):
        with pytest.raises((token_files.BadFile, struct.error)):
            opened(bad)
    with pytest.raises(token_files.BadFile, match="checksum"):
        opened(data[:300] + bytes([data[300] ^ 1]) + data[301:]).check()


def test_chunk_widths_are_the_cheapest():
    rng = np.random.default_rng(5)

    def cuts(n):
        return [[]] if n == 0 else [[i, *rest] for i in range(1, min(n, 8) + 1) for rest in cuts(n - i)]

    def cost(lengths, widths):
        low, bits = 0, 0.0
        for k, w in enumerate(widths):
            holders = lengths[low + 1 if low else 0 :].sum()
            bits += holders * (w + (0 if k == len(widths) - 1 else 2 + 16 / 512 + 64 / 65536))
            low += w
        return bits

    for _ in range(20):
        lengths = np.zeros(33, dtype=np.int64)
        top = int(rng.integers(1, 12))
        lengths[1 : top + 1] = rng.integers(0, 1000, top)
        lengths[top] += 1
        assert abs(cost(lengths, token_files.best_widths(lengths)) - min(cost(lengths, c) for c in cuts(top))) < 1e-6


def odd_texts():
    rng = random.Random(3)
    signs = " \n\t \u180e abcZ19.,'é日\x1c\x85\u200b\ufeff\U0001f600"
    texts = ["", None, "a  b\n c", "  x ", "y  z", "<|endoftext|> b <|endoftext|>", "it's John's 'll ' s", "日本語 テキスト", "\r\n \r\n a"]
    return texts + ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)] + ["ab c. " * 40_000, "x" * 30_000]


def test_cut_texts_encode_as_whole_ones(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "STRETCH", 1 << 15)
    monkeypatch.setattr(token_files, "CACHED_WORDS", 500)
    plain, texts, encoder = Tokenizer.from_file(VOCABULARY), odd_texts(), token_files.Encoder(VOCABULARY)
    for i in range(0, len(texts), 100):
        part = texts[i : i + 100]
        ids, bounds = encoder.documents(part, 0)
        for k, text in enumerate(part):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == [*plain.encode(text or "", add_special_tokens=False).ids, 0]


def test_op13_equals_the_library(spark, monkeypatch):
    from tokenizers import Tokenizer

    plain, texts = Tokenizer.from_file(VOCABULARY), odd_texts()
    rows = [(i * 7919 % 10_007, t) for i, t in enumerate(texts)] + [(None, "null id"), (5, "again"), (5, "again"), (5, "other")]
    folder = write_table(spark, "documents", docs_of(spark, rows).repartition(6))
    found = registry.op13_token_files(spark, folder)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and {t for _, t in found.dtypes} == {"bigint"}
    got = sorted(map(tuple, found.collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [None, *sorted(i for i, _ in rows if i is not None)]
    expected, at = {}, 0
    for i, t in rows:
        ids = [*plain.encode(t or "", add_special_tokens=False).ids, 0]
        expected.setdefault(i, []).append((len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
    for i, start, n, crc in got:
        assert start == at
        at += n
        expected[i].remove((n, crc))
    assert not any(expected.values())


def test_token_files_of_an_empty_table_and_several_files(spark):
    docs = docs_of(spark, [(i, "some words " * i) for i in range(300)])
    none = settle(token_files.write_token_files(docs.limit(0), shared_folder(spark, "tokens"), VOCABULARY), "none")
    assert none.rows == 0 and token_files.read_token_files(none.df, 0).count() == 0
    written = settle(token_files.write_token_files(docs.withColumn("n_ids", F.lit(1)), shared_folder(spark, "tokens"), VOCABULARY), "some")
    rows = token_files.read_token_files(written.df, written.rows).orderBy("start").collect()
    assert [r.doc_id for r in rows] == list(range(300)) and rows[-1].start == sum(r.n_tokens for r in rows[:-1])

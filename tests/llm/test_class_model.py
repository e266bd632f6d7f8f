"""The class model against brute force: gains of moves, sweeps, classes of rarer words, and scores word by word."""

import math
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from metropulse.llm import brown
from metropulse.llm import words as words_module
from metropulse.llm.words import mix, word_hashes


def texts_of(seed, n=300):
    rng = random.Random(seed)
    kinds = [[f"{a}{i}" for i in range(40)] for a in ("north", "south", "east")]
    line = lambda: " ".join(rng.choice(kinds[j % 3]) for j in range(rng.randrange(0, 50)))
    return [line() for _ in range(n)] + ["once only words", "", None, "Word word WORD"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def hashed(word):
    words, _, endings = word_hashes(pa.array([word]), brown.ENDINGS)
    return int(words[0]), int(endings[0])


def test_move_scores_are_differences_of_the_likelihood():
    rng = np.random.default_rng(5)
    units, classes = 30, 6
    n = rng.poisson(1.5, (units, units))
    n[4, 4] = 9
    of = rng.integers(1, classes, units)
    of[0] = 0
    member = np.eye(classes)[of]
    table = member.T @ n @ member
    some = np.arange(1, units)
    score = brown.move_scores((n @ member)[some], (n.T @ member)[some], np.diag(n)[some].astype(float), table, of[some])
    for row, u in enumerate(some):
        whole = []
        for k in range(1, classes):
            trial = of.copy()
            trial[u] = k
            m = np.eye(classes)[trial]
            whole.append(brown.likelihood(m.T @ n @ m))
        assert score[row, 1:] - score[row, 1] == pytest.approx(np.array(whole) - whole[0], abs=1e-6)


@pytest.mark.parametrize("in_a_row", [64, brown.ROW_PAIRS])
def test_pairs_and_sweeps_by_brute_force(spark, monkeypatch, in_a_row):
    monkeypatch.setattr(brown, "ROW_PAIRS", in_a_row)
    monkeypatch.setattr(brown, "PAIRS_FLUSH", 4 * in_a_row)
    texts = texts_of(1)
    df = frame(spark, texts).select(F.coalesce("text", F.lit("")).alias("text"))
    known = brown.count_vocabulary(df, 60)
    assert 0 < len(known.common) <= 60
    unit = {int(h): 1 + i for i, h in enumerate(known.common)}
    span = 1 + len(known.common) + brown.ENDINGS
    want = np.zeros((span, span), np.int64)
    for t in texts:
        before = 0
        for w in [*(t or "").lower().split(), None]:
            h, e = hashed(w) if w else (None, None)
            now = 0 if w is None else unit.get(h, 1 + len(known.common) + e)
            want[before, now] += 1
            before = now
    pairs = brown.count_pairs(df, known)
    got, other = np.zeros_like(want), np.zeros_like(want)
    for r in pairs.collect():
        a, b, n = brown._firsts(r.asDict())
        p, q, m = brown._seconds(r.asDict())
        got[a, b] += n
        other[p, q] += m
        assert (np.diff(a) >= 0).all() and (np.diff(q) >= 0).all()
    assert (got == want).all() and (other == want).all()

    rng = np.random.default_rng(0)
    of = rng.integers(1, 5, span)
    of[0] = 0
    member = np.eye(5)[of]
    start = member.T @ want @ member
    swept, table = brown.sweep(pairs, of, 5, 6)
    member = np.eye(5)[swept]
    assert (member.T @ want @ member == table).all() and swept[0] == 0 and swept[1:].min() >= 1
    assert brown.likelihood(table) > brown.likelihood(start)


@pytest.mark.parametrize("common", [0, 25, 1000])
def test_scores_word_by_word(spark, common):
    texts = texts_of(2)
    df = frame(spark, texts)
    train = df.where("doc_id % 3 <> 0").select("text")
    model = brown.fit(train, common)
    known = model.vocabulary
    counts = {}
    for i, t in enumerate(texts):
        if i % 3:
            for w in (t or "").lower().split():
                counts[w] = counts.get(w, 0) + 1
    chosen = {}
    for r in model.table.collect():
        for h, c in zip(np.frombuffer(r.words, np.uint64), np.frombuffer(r.classes, np.int16), strict=True):
            chosen[int(h)] = int(c)
    unit = {int(h): 1 + i for i, h in enumerate(known.common)}
    assert len(unit) == (len(counts) if common == 1000 else len(unit)) <= max(common, len(unit))
    # Every word seen twice or more is a unit or has a class of its own.
    assert all(hashed(w)[0] in unit or chosen[hashed(w)[0]] >= 1 for w, n in counts.items() if n >= brown.CLASSED)
    assert all(hashed(w)[0] in unit or chosen[hashed(w)[0]] == -1 for w, n in counts.items() if n < brown.CLASSED)

    def p(before, w):
        """(log10 probability, class as the next word's context)"""
        if w is None:
            return model.step[before, 0] + model.inside[0], 0
        h, e = hashed(w)
        if h in unit:
            k = model.classes[unit[h]]
            return model.step[before, k] + model.inside[unit[h]], k
        tail = 1 + len(known.common) + e
        context = model.classes[tail]
        c = chosen.get(h, -1)
        if c >= 0:
            return model.step[before, c] + model.rarer[c] + math.log10(counts[w]), context
        here = model.step[before, context] + model.inside[tail] - model.ending_down[e]
        return here + math.log10(counts.get(w, 0) + 1), context

    rows = brown.score_texts(df, model, "doc_id", "text", F.col("doc_id") % 3 == 0).collect()
    assert len(rows) == len(texts)
    for r in rows:
        total, before = 0.0, 0
        for w in [*(texts[r.doc_id] or "").lower().split(), None]:
            more, before = p(before, w)
            total += more
        assert r.score == pytest.approx(total, abs=1e-6)

    # From any context, all words seen and the unseen word of every ending have no more than one together.
    for before in (0, 1, brown.CLASSES - 1):
        mass = 10 ** p(before, None)[0] + sum(10 ** p(before, w)[0] for w in counts)
        tails = 1 + len(known.common) + np.arange(brown.ENDINGS)
        unseen = model.step[before, model.classes[tails]] + model.inside[tails] - model.ending_down
        mass += (10**unseen).sum()
        assert mass == pytest.approx(1, abs=1e-6)


def test_rarer_words_take_the_class_of_their_contexts(spark):
    texts = texts_of(6)
    df = frame(spark, texts).select(F.coalesce("text", F.lit("")).alias("text"))
    known = brown.count_vocabulary(df, 30)
    span = 1 + len(known.common) + brown.ENDINGS
    rng = np.random.default_rng(1)
    k = 5
    of = rng.integers(1, k, span)
    of[0] = 0
    given, after = rng.dirichlet(np.ones(k), k), rng.integers(50, 900, k)
    table, moved = brown.class_rare_words(df, known, of, given, after)
    unit = {int(h): 1 + i for i, h in enumerate(known.common)}
    contexts = {}
    for t in texts:
        before = 0
        for w in (t or "").lower().split():
            h, e = hashed(w)
            if h not in unit:
                contexts.setdefault((h, e), np.zeros(k))[of[before]] += 1
            before = unit.get(h, 1 + len(known.common) + e)
    chosen = {}
    for r in table.collect():
        chosen |= dict(zip(np.frombuffer(r.words, np.uint64).tolist(), np.frombuffer(r.classes, np.int16).tolist(), strict=True))
    want = np.zeros((k, k))
    for (h, e), n in contexts.items():
        best = -1
        if n.sum() >= brown.CLASSED:
            best = max(range(1, k), key=lambda c: n @ np.log(given[:, c]) - n.sum() * math.log(after[c]))
            want[:, best] += n
            want[:, of[1 + len(known.common) + e]] -= n
        assert chosen[h] == best
    assert len(contexts) > 50 and (moved == want).all()


def test_empty_table(spark):
    df = frame(spark, ["a"]).limit(0)
    model = brown.fit(df.select("text"))
    assert brown.score_texts(df, model, "doc_id", "text", F.lit(False)).count() == 0
    only = frame(spark, ["new words", None])
    rows = brown.score_texts(only, model, "doc_id", "text", F.lit(True)).collect()
    assert len(rows) == 2 and all(math.isfinite(r.score) and r.n_known == 0 for r in rows)


def test_units_are_looked_up_once_per_different_word(monkeypatch):
    """Frequent words cost no search of their own at every place."""
    rng = np.random.default_rng(3)
    words = mix(rng.integers(0, 50, 20_000).astype(np.uint64))
    common, endings = np.unique(words)[::2], rng.integers(0, brown.ENDINGS, len(words))
    searched, find = [], brown._find
    monkeypatch.setattr(brown, "_find", lambda sorted_, x: searched.append(len(x)) or find(sorted_, x))
    units = brown.units_of(words, endings, common)
    place = {int(w): 1 + i for i, w in enumerate(common)}
    assert units.tolist() == [place.get(int(w), 1 + len(common) + e) for w, e in zip(words, endings, strict=True)]
    assert sum(searched) <= 50
    assert brown.units_of(words[:0], endings[:0], common).tolist() == []


def test_orders_by_digits_are_stable():
    rng = np.random.default_rng(4)
    for top in (1, 7, 1 << 16, 70_000, 1 << 30):
        unit, to = rng.integers(0, top, 5000).astype(np.int32), rng.integers(0, 9, 5000)
        assert (brown._stable_order(unit, to) == np.lexsort((unit, to))).all()
        assert (brown._stable_order(to) == np.argsort(to, kind="stable")).all()
    assert len(brown._stable_order(to[:0])) == 0


@pytest.mark.parametrize("piece", [1 << 20, 64])
def test_words_of_odd_texts(monkeypatch, piece):
    """Words, their numbers and endings where texts begin and end in words or in gaps, whatever the piece."""
    monkeypatch.setattr(words_module, "SLICE_BYTES", piece // 2)
    texts = ["ab", "cd", None, "", "   ", "x", " lead", "trail \t", "é" * 9, "a" * 300, "A\x0bB\x0cC\r\nd", "\u00a0one", "ab cd" + " " * 200 + "e"]
    hashes, at, endings = word_hashes(pa.array(texts * 3), brown.ENDINGS)
    want = [re.findall("[^ \t-\r]+", t or "") for t in texts * 3]
    assert np.diff(at).tolist() == [len(w) for w in want]
    flat = [hashed(w) for ws in want for w in ws]
    assert list(zip(hashes.tolist(), endings.tolist(), strict=True)) == flat
    assert len(set(hashes.tolist())) == len({w.lower() for ws in want for w in ws})


def traced(run):
    """What ``run`` returns, and the most bytes held meanwhile."""
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_rows_of_the_bigram_shuffle_are_small():
    """Spark hands a task 10,000 rows at once: few buckets with many bigrams each must not make large rows."""
    rng = np.random.default_rng(8)
    span, buckets = 5000, 3
    keys = np.unique(rng.integers(0, span * span, 300_000))
    n = rng.integers(1, 9, len(keys))
    got = {True: [], False: []}
    for batch in brown._dealt(keys, n, span, buckets):
        assert batch.num_rows <= brown.SHUFFLE_ROWS
        for r in batch.to_pylist():
            a, b, times = (np.frombuffer(r[c], np.int32) for c in "abn")
            assert 10_000 * 3 * a.nbytes <= 16 << 20 and 0 < len(a) == len(b) == len(times)
            assert (brown._bucket((a if r["side"] else b).astype(np.uint64), buckets) == r["bucket"]).all()
            got[r["side"]].append((a.astype(np.int64) * span + b, times.astype(np.int64)))
    for side in got.values():
        found, times = brown._add_up(side)
        assert (found == keys).all() and (times == n).all()
    assert list(brown._dealt(keys[:0], n[:0], span, buckets)) == []


def test_hashing_words_holds_little():
    texts = pa.array(["some words of a text that is long enough " * 50] * 1024)  # 2 MB, a slice
    (hashes, at, _), most = traced(lambda: word_hashes(texts, brown.ENDINGS))
    assert len(hashes) == at[-1] == 9 * 50 * 1024
    assert most <= 40 << 20

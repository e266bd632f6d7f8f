"""Cases that earlier versions lost: mixed lengths, long lists, rare languages, shared ids, clashing names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from metropulse.llm import language, nn_descent, posting_lists, registry, sanitise, token_counts
from metropulse.operators.staging import settle

DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_tokens long"
VECTORS = "vec_id long, label int, embedding array<double>"


def brute_links(rows):
    fit = {i: (l, np.array(x)) for i, l, x in rows}
    links, label = dict.fromkeys(fit, 0), {i: i for i in fit}
    near = []
    for a, (la, x) in fit.items():
        for b, (lb, y) in fit.items():
            if a < b and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                near.append((a, b))
                links[a] += 1
                links[b] += 1
    changed = True
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (links[i], label[i]) for i in fit}


def near(spark, rows):
    table = spark.createDataFrame(rows, VECTORS)
    return {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(table).collect()}


@pytest.mark.parametrize("lengths", [(3, 4), (3, 5), (8, 8, 16)])
def test_vectors_of_several_lengths(spark, lengths):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        n = lengths[i % len(lengths)]
        centre = np.eye(n)[i % 3]
        rows.append((i, i % 2, (centre + 0.03 * rng.standard_normal(n)).tolist()))
    assert near(spark, rows) == brute_links(rows)


def test_saturated_lists_grow(spark, monkeypatch):
    """Two clumps of 30: every first list holds its own clump only, and no blocks are compared between components."""
    rng = np.random.default_rng(4)
    rows = []
    for c, centre in enumerate([[1.0, 0.0], [0.985, (1 - 0.985**2) ** 0.5]]):
        rows += [(30 * c + i, 1, [*centre, *(0.003 * rng.standard_normal(14)).tolist()]) for i in range(30)]
    monkeypatch.setattr(nn_descent, "_bridges", lambda *a: (_ for _ in ()).throw(AssertionError("lists were long enough")))
    assert near(spark, rows) == brute_links(rows)


def test_links_too_rare_for_the_audit(spark, monkeypatch):
    """One linked pair among vectors of which the audit sees few."""
    monkeypatch.setattr(nn_descent, "AUDIT", 4)
    monkeypatch.setattr(nn_descent, "AUDIT_BYTES", 4 * 8 * 32)
    rng = np.random.default_rng(6)
    rows = [(i, 1, rng.standard_normal(32).tolist()) for i in range(300)]
    rows[123] = (123, 1, [1.001 * v + 1e-4 for v in rows[7][2]])
    assert near(spark, rows) == brute_links(rows)


def test_every_labelled_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_TRAIN", 200)
    rng = random.Random(1)
    say = lambda sounds: " ".join("".join(rng.choice(sounds) for _ in range(3)) for _ in range(20))
    a, b, c = ["ka", "ro", "mi"], ["sch", "un", "der"], ["qu", "eau", "oix"]
    rows = [(i, "sch un der " * 9, "bb") for i in range(3000)] + [(5000 + i, say(b), "bb") for i in range(1000)]
    rows += [(9000 + i, say(a), "aa") for i in range(40)] + [(9900 + i, say(c), "cc") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs, "text", "lang", F.lit(True), max_train=200)
    assert model.langs == ["aa", "bb", "cc"]
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, model, keep=["doc_id"]).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) == len(rows)


def test_texts_that_share_an_id_are_judged_apart(spark):
    import corpus_pipeline

    rng = random.Random(2)
    a, b = (" ".join(f"w{rng.randrange(900)}" for _ in range(60)) for _ in range(2))
    near_b = b + " end"
    rows = [(1, a), (2, a), (2, b), (5, near_b), (6, None), (6, None), (7, ""), (None, a), (8, "x y"), (8, "x y")]
    docs = spark.createDataFrame([(i, t, "en", "s", 3, 1) for i, t in rows], DOCS)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == corpus_pipeline.COLUMNS
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([(1, a), (2, b), (6, None), (6, None), (7, ""), (None, a), (8, "x y")], key=str)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").count() == 0
        assert stage(spark, docs, "").count() > 0


def test_encoded_lengths_once_and_of_any_table(spark):
    import public_tokenizers
    import tiktoken

    vocabulary = f"{registry.TOKENIZERS}/byte_bpe_50k.tiktoken"
    encoding: tiktoken.Encoding = token_counts._encoding(vocabulary, public_tokenizers.PATTERN)
    texts = [None, "", "a b  c", "<|endoftext|>", "word " * 50_000, "é日", "a b  c"]
    docs = spark.createDataFrame([(i, t, "en", "s", 3, 77) for i, t in enumerate(texts)], DOCS)
    made = token_counts.encoded_lengths(docs, vocabulary, public_tokenizers.PATTERN)
    assert made.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens"]
    got = {r.doc_id: r.n_tokens for r in made.collect()}
    assert got == {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert str(made._jdf.queryExecution().optimizedPlan()).count("MapInArrow") == 1
    histogram = token_counts.length_histogram(made)
    assert "MapInArrow" not in str(histogram._jdf.queryExecution().optimizedPlan())
    counts = {r.n_tokens: (r.n_docs, r.total_tokens) for r in histogram.collect()}
    assert counts == {n: (list(got.values()).count(n), sum(got.values())) for n in set(got.values())}


# --- personal data -------------------------------------------------------------------------------------------------------


def letters(rng, n, names):
    return " ".join(rng.choice(names) for _ in range(n))


@pytest.fixture(scope="module")
def vocabulary():
    rng = random.Random(11)
    return ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 8))) for _ in range(400)]


def brute_disclosing(texts, pattern):
    """The method on whole texts, in plain Python: (entity, term) by PMI, classes of least shingle hashes replaced by the shingle sets'
    own overlap being none here."""
    import math
    import re

    distinct = sorted(set(texts))
    words = {t: re.findall(r"[^\W\d_]+", t.lower()) for t in distinct}
    terms = {t: {" ".join(w[i : i + n]) for n in range(1, 5) for i in range(len(w) - n + 1)} for t, w in words.items()}
    held = {t: set(re.findall(pattern, t)) for t in distinct}
    out = {}
    for entity in set().union(*held.values()):
        mine = [t for t in distinct if entity in held[t]]
        if len(mine) < 3:
            continue
        ic = math.log2(len(distinct) / len(mine))
        for term in set().union(*(terms[t] for t in mine)):
            n_te, n_t = sum(term in terms[t] for t in mine), sum(term in terms[t] for t in distinct)
            pmi = math.log2(n_te * len(distinct) / (n_t * len(mine)))
            if n_te >= 3 and pmi >= 0.8 * ic:
                out[entity, term] = n_te == n_t
    return out


def test_disclosing_terms_equal_brute_force(spark, vocabulary):
    rng = random.Random(12)
    texts = [letters(rng, 30, vocabulary) for _ in range(300)]
    for i in range(24):
        texts.append(f"{letters(rng, 9, vocabulary)} Rosalind {letters(rng, 12, vocabulary)} Mary Ann {letters(rng, 4, vocabulary)} ann@ex.org {letters(rng, 9, vocabulary)}")
        texts.append(f"{letters(rng, 15, vocabulary)} Mary {letters(rng, 9, vocabulary)} Ann {letters(rng, 9, vocabulary)}" + " +1 234 567 8901" * (i % 3 == 0))
    docs = spark.createDataFrame([(t,) for t in texts], "t string")
    keyed = docs.select(*sanitise._key(F.col("t")), "t", sanitise.base_spans(F.col("t")).alias("spans")).where("size(spans) > 0")
    terms = sanitise.disclosing_terms(docs, settle(keyed, "found").df)
    got = {(r.v, r.term): r.sure for r in terms.collect()}
    want = brute_disclosing(texts, r"\S+@\S+|\+[0-9 ]+[0-9]")
    short = {k: v for k, v in want.items() if " " not in k[1]}
    covered = {k for k in want if any((k[0], p) in want for p in (k[1].rsplit(" ", 1)[0], k[1].split(" ", 1)[-1]) if p != k[1])}
    assert got == short | {k: v for k, v in want.items() if " " in k[1] and k not in covered}
    assert got["ann@ex.org", "rosalind"] and got["ann@ex.org", "mary ann"] and ("ann@ex.org", "mary") not in got


@pytest.mark.parametrize("line", ["Rosalind {e}", "Rosalind Franklin {e}", "Rosalind Franklin {w} {e}"])
def test_names_go_wherever_they_stand(spark, vocabulary, line):
    rng = random.Random(13)
    noise = [(i, letters(rng, 25, vocabulary)) for i in range(60)]
    told = []
    for i in range(20):
        body = line.format(e="ann@ex.org", w=letters(rng, 13, vocabulary))
        told.append((100 + i, f"{letters(rng, 8, vocabulary)} {body} {letters(rng, 8, vocabulary)}"))
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 1) for i, t in noise + told], DOCS)
    got = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert not any("Rosalind" in got[i] or "Franklin" in got[i] or "ann@" in got[i] for i, _ in told)
    assert all(got[i] == t for i, t in noise)
    for i, t in told:  # nothing else is taken
        lost = [w for w in t.split() if w not in got[i].split() and w not in ("Rosalind", "Franklin", "ann@ex.org")]
        assert lost == []


def test_many_spans_in_one_text_take_seconds(spark):
    import re
    import time

    text = " ".join(f"user{i}@mail{i % 7}.example.org," for i in range(16_000))
    docs = spark.createDataFrame([(1, text, "en", "s", 1, 1), (2, None, "en", "s", 1, 1)], DOCS)
    begun = time.time()
    found = sanitise.find_personal(docs).select("row.doc_id", "base").collect()
    clean = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert time.time() - begun < 60
    spans = [(x.s, x.e) for r in found if r.doc_id == 1 for x in r.base]
    assert spans == [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    assert clean == {1: " ".join(["<EMAIL>,"] * 16_000), 2: None}
    assert "Python" not in str(sanitise.sanitise(docs)._jdf.queryExecution().executedPlan())


def test_running_sums(spark):
    rng = random.Random(14)
    rows = [[rng.randrange(100) for _ in range(n)] for n in (0, 1, 63, 64, 65, 128, 1000)]
    df = spark.createDataFrame([(r,) for r in rows], "a array<bigint>")
    sums = df.select("a", sanitise._running(F.col("a"), lambda a, b: a + b, 0).alias("s"), sanitise._running(F.col("a"), lambda a, b: F.greatest(a, b), 0).alias("m"))
    for r in sums.collect():
        assert r.s == [sum(r.a[:i]) for i in range(len(r.a))] and r.m == [max([0, *r.a[:i]]) for i in range(len(r.a))]


# --- nearest neighbours ------------------------------------------------------------------------------------------------------


def brute_nearest(rows, k):
    fit = [(i, np.array(x)) for i, x in rows]
    out = {}
    for q, x in fit:
        if q % 20 == 0:
            near = sorted((-float(x @ y), i) for i, y in fit if i != q and len(x) == len(y))[:k]
            out[q] = [i for _, i in near]
    return out


def nearest(spark, rows, k=20):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = posting_lists.nearest_by_product(table, F.col("vec_id") % 20 == 0, k).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


def test_each_vector_length_has_its_index(spark):
    rng = np.random.default_rng(21)
    rows = [(i, rng.standard_normal(6 if i % 3 else 9).tolist()) for i in range(200)] + [(1000, rng.standard_normal(4).tolist())]
    got, want = nearest(spark, rows), brute_nearest(rows, 20)
    assert got == {q: ids for q, ids in want.items() if ids}


def test_recall_with_more_lists_than_probes(spark):
    rng = np.random.default_rng(22)
    centres = rng.standard_normal((120, 24))
    rows = [(i, (centres[i % 120] + 0.3 * rng.standard_normal(24)).tolist()) for i in range(6000)]
    got, want = nearest(spark, rows), brute_nearest(rows, 20)
    recall = np.mean([len(set(got[q]) & set(ids)) / len(ids) for q, ids in want.items()])
    assert set(got) == set(want) and recall >= 0.9

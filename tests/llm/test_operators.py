"""Operators against brute force on small fixtures; nulls, empty tables, repeats and clashing columns."""

import hashlib
import math
import random
import re
import struct
import zlib

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from metropulse.llm import brown, language, nn_descent, ngram_join, packing, pieces, posting_lists, registry, sanitise
from metropulse.llm import token_counts, warc
from metropulse.operators.staging import settle, shared_folder

MODEL = f"{registry.TOKENIZERS}/piece_bpe_32k.model"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, node long, h1 long"


def docs_of(spark, texts, lang="en"):
    rows = [(i, t, lang, "s", len(t or ""), 1, 2, 3) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def words_of(rng, n, vocabulary=5000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def shingles(text, width=5):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_components(texts):
    sets = [shingles(t) for _, t in texts]
    label = [i for i, _ in texts]
    changed = True
    near = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] and sets[b] and texts[a][0] is not None and texts[b][0] is not None and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in near:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return [(i, len(s), c) for (i, _), s, c in zip(texts, sets, label, strict=True)]


def near_texts():
    rng = random.Random(4)
    texts = []
    for _ in range(6):
        base = words_of(rng, 60).split()
        for _ in range(15):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    base = words_of(rng, 150).split()  # a long list's group, with members on either side of the threshold
    for _ in range(300):
        copy = list(base)
        for _ in range(rng.randrange(9)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), "", "  \n", "one two", "ONE  two", "one", words_of(rng, 3000)]
    rng.shuffle(texts)
    return [*enumerate(texts), (None, texts[0]), (7000, None), (7001, texts[3]), (7001, texts[3])]


def test_jaccard_components_equal_brute_force(spark):
    texts = near_texts()
    got = ngram_join.ngram_jaccard_components(docs_of(spark, texts)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == sorted(brute_components(texts), key=key)
    assert ngram_join.ngram_jaccard_components(docs_of(spark, [])).count() == 0


def test_packing_fills_and_shrinks(spark):
    rng = random.Random(1)
    texts = [(i, words_of(rng, rng.choice([0, 1, 5, 40, 300, 5000]))) for i in range(200)] + [(None, "a b"), (3, None), (9, "x"), (9, "x")]
    length = packing.word_tokens(F.col("text"))
    rows = packing.best_fit_pack(docs_of(spark, texts), length, block_rows=64).collect()
    want = sorted(len((t or "").encode().split()) + 1 for _, t in texts)
    by_doc, bins = {}, {}
    for r in rows:
        bins.setdefault((r.block, r.bin), []).append(r)
    assert sum(r.length for r in rows) == sum(want)
    for held in bins.values():
        held.sort(key=lambda r: r.offset)
        ends = [0]
        for r in held:
            assert r.offset == ends[-1]
            ends.append(r.offset + r.length)
        (capacity,) = {r.capacity for r in held}
        assert ends[-1] <= capacity == min(c for c in packing.LENGTHS if c >= ends[-1])
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert sum(r.length for r in by_doc[0]) == len(texts[0][1].split()) + 1
    assert packing.best_fit_pack(docs_of(spark, []), length).count() == 0


def test_packing_takes_the_tightest_bin():
    lengths = np.array([6, 5, 4, 3, 2])
    bins, capacity, offset = packing.pack(lengths, {10: 10.0})
    assert bins.tolist() == [0, 1, 0, 1, 1] and set(capacity) == {10} and offset.tolist() == [0, 0, 6, 5, 8]


def test_length_histogram(spark):
    values = [0, 3, 3, 7, 2500, 2500, 9]
    table = spark.createDataFrame([(v,) for v in values] + [(None,)], "n_tokens long")
    made = token_counts.length_histogram(table)
    for r in made.collect():
        at = r.n_tokens
        assert r.docs_from == sum(v >= at for v in values) and r.docs_upto == sum(v <= at for v in values)
        assert r.tokens_from == sum(v for v in values if v >= at) and r.total_tokens == sum(values)
        assert r.truncated_tokens == sum(min(v, at) for v in values)
    assert token_counts.quantile(made, 0.5).first().length == 7
    assert token_counts.at_limit(made, 8).first().tokens == sum(min(v, 8) for v in values)
    assert token_counts.length_histogram(table.limit(0)).count() == 0


def test_class_model_base_score_and_gain(spark):
    rng = random.Random(2)
    kinds = [[f"{a}{i}" for i in range(60)] for a in "pqr"]
    line = lambda: " ".join(rng.choice(kinds[j % 3]) for j in range(rng.randrange(1, 60)))
    texts = [(i, line()) for i in range(400)] + [(900, None), (901, "never seen"), (901, "never seen"), (None, "p1 q1")]
    docs = docs_of(spark, texts)
    held = language.in_fold("doc_id", 7, 2)
    rows = brown.score_texts(docs, brown.fit(docs.where(~held).select("text")), "doc_id", "text", held).collect()
    assert len(rows) == len(texts)
    out = {i: zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in texts}
    counts, n = {}, 0
    for i, t in texts:
        if not out[i]:
            for w in [*(t or "").split(), None]:
                counts[w] = counts.get(w, 0) + 1
                n += 1
    by = {(r.doc_id): r for r in rows}
    for i, t in texts:
        tokens = [*(t or "").split(), None]
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + len(counts) + 1)) for w in tokens)
        r = by[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[i], len(tokens), n)
        assert r.n_known == sum(w in counts for w in tokens) and r.base_score == pytest.approx(base)
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out) + 100
    empty = docs.limit(0)
    assert brown.score_texts(empty, brown.fit(empty.select("text")), "doc_id", "text", held).count() == 0


def vectors_of(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    rows = [(i, (base[i % 60] + (0.02 if i % 2 else 0.0) * rng.standard_normal(16)).tolist(), int(i % 60 % 3)) for i in range(300)]
    rows += [(300 + i, [1.0] * 16, 1) for i in range(40)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [1.0] * 16, None), (404, [None] * 16, 1)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nn_descent_equals_brute_force(spark):
    rows, table = vectors_of(spark)
    fit = [(i, np.float32(x).astype(float), l) for i, x, l in rows if i < 400]
    got = {r.vec_id: r for r in nn_descent.near_duplicates(table).collect()}
    label = {i: i for i, _, _ in rows}
    links = dict.fromkeys(label, 0)
    near = [(a[0], b[0]) for a in fit for b in fit if a[0] < b[0] and a[2] == b[2] and a[1] @ b[1] / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98]
    for a, b in near:
        links[a] += 1
        links[b] += 1
    for _ in range(20):
        for a, b in near:
            label[a] = label[b] = min(label[a], label[b])
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items()} == {i: (links[i], label[i], label[i] == i) for i in label}
    assert nn_descent.near_duplicates(table.limit(0)).count() == 0


def test_near_vectors_link_two_saturated_clumps(spark):
    rng = np.random.default_rng(4)
    centres = [[1.0, 0.0], [0.985, math.sqrt(1 - 0.985**2)], [-1.0, 0.0]]
    rows = [(20 * c + i, 1, [*centre, *(0.004 * rng.standard_normal(14)).tolist()]) for c, centre in enumerate(centres) for i in range(20)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(table).collect()}
    assert got == {i: (39, 0) if i < 40 else (19, 40) for i in range(60)}


def test_near_vectors_lost_pairs_are_noticed(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, 1, [5.0, *(0.01 * rng.standard_normal(23)).tolist()]) for i in range(150)]
    for i in range(60):
        x = rng.standard_normal(24)
        rows += [(1000 + 2 * i + j, 1, (x + 0.005 * j).tolist()) for j in range(2)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    descend = nn_descent._descend
    # Descent that loses the isolated pairs: only lists of the hot group, whose links reach the threshold in full.
    lose = lambda *a: (lambda d: d.join(d.where("sim >= 0.98").groupBy("u").count().where("count > 5").select("u"), "u"))(descend(*a))
    monkeypatch.setattr(nn_descent, "_descend", lose)
    got = {r.vec_id: (r.n_links, r.component_id) for r in nn_descent.near_duplicates(table).collect()}
    want = {i: (149, 0) for i in range(150)} | {1000 + i: (1, 1000 + i - i % 2) for i in range(120)}
    assert got == want


def test_posting_lists_recall_and_scores(spark):
    rows, table = vectors_of(spark)
    fit = [(i, np.float32(x).astype(float)) for i, x, _ in rows if i < 400 or i == 403]
    got = {}
    for r in posting_lists.nearest_by_product(table, F.col("vec_id") % 20 == 0, 20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    hit = 0
    asked = [f for f in fit if f[0] % 20 == 0]
    assert set(got) == {i for i, _ in asked}
    for i, x in asked:
        want = sorted(((-float(x @ y), j) for j, y in fit if j != i))[:20]
        mine = sorted(got[i])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        hit += len({j for _, j in want} & {j for _, j, _ in mine})
    assert hit >= 0.9 * 20 * len(asked)
    assert posting_lists.nearest_by_product(table.limit(0), F.lit(True), 20).count() == 0
    again = posting_lists.nearest_by_product(table.union(table).union(table), F.col("vec_id") % 20 == 0, 20).collect()
    assert {i: sorted((r.rank, r.vec_id, r.score) for r in again if r.query_id == i) for i in got} == {i: sorted(v) for i, v in got.items()}
    few = table.where("vec_id < 3")
    assert posting_lists.nearest_by_product(few, F.col("vec_id") == 0, 20).count() == 2


def test_posting_lists_reach_beyond_a_tight_group(spark):
    rng = np.random.default_rng(12)
    base = rng.standard_normal((48, 16))
    base /= np.linalg.norm(base, axis=1)[:, None]
    # The nearest list is so near that no other is within the ratio: more probes alone read a dozen lists for ever.
    x = np.repeat(base, 100, axis=0) + 0.001 * rng.standard_normal((4800, 16))
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {}
    for r in posting_lists.nearest_by_product(table, F.col("vec_id") % 400 == 0, 2400).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    shares = []
    for i in range(0, 4800, 400):
        score = x @ x[i]
        score[i] = -9
        shares.append(len(got[i] & set(np.argsort(-score)[:2400].tolist())) / 2400)
    print("recall", np.mean(shares), min(shares))
    assert np.mean(shares) >= 0.96 and min(shares) >= 0.75


def test_posting_lists_keep_the_best_of_a_small_buffer(spark, monkeypatch):
    _, table = vectors_of(spark)
    find = lambda: sorted(map(tuple, posting_lists.nearest_by_product(table, F.col("vec_id") % 20 == 0, 20).collect()))
    whole = find()
    monkeypatch.setattr(posting_lists, "HELD", 50)
    assert find() == whole


def test_archives_round_trip(spark):
    big, other = "é<p>" * 500, "b" * 1000
    rows = [(1, "http://a", big), (5, None, big), (3, "u", big), (7, "v", None), (8, "w", "tiny"), (9, "x", "tiny"), (None, "y", other), (4, "z", other)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = shared_folder(spark, "warc-test")
    records = warc.plan_records(pages)
    manifest = settle(warc.write_archives(records, folder, warc.train_dictionary(pages)), "m")
    got = {r.page_id: r for r in warc.read_archives(manifest.df, manifest.rows).collect()}
    for i, _, html in rows:
        data = (html or "").encode()
        r = got[i]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        assert r.record_type == ("revisit" if i in (1, 3, None) else "response")
        assert r.refers_to == {1: 5, 3: 5, None: 4}.get(i)
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == data


def test_archives_of_odd_pages(spark, monkeypatch):
    schema = "page_id long, url string, html string, payload string, leader long"
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 2000)  # many files, read in many tasks
    long = "long " * 1_000_000
    rows = [(i, f"http://a/{i} b\tc", f"{i} <p>" * (300 + i), "x", 1) for i in range(40)]
    rows += [(90, None, long, None, None), (None, "n", None, None, None), (91, "n", "", None, 4), (91, "n", "", None, 4)]
    pages = spark.createDataFrame(rows, schema)
    for table, n in ((pages, len(rows)), (pages.limit(0), 0)):
        folder = shared_folder(spark, "warc-odd")
        manifest = settle(warc.write_archives(warc.plan_records(table), folder, warc.train_dictionary(table)), "m")
        read = warc.read_archives(manifest.df, manifest.rows)
        got = read.collect()
        assert len(got) == n
        if n:
            assert manifest.rows > 3 and read.rdd.getNumPartitions() >= min(manifest.rows, 8)
            url = next(f for f in read.columns if "ur" in f)
            assert {r[url] for r in got if r.page_id == 7} == {"http://a/7%20b%09c"}
            assert bytes(next(r.payload for r in got if r.page_id == 90)) == long.encode()
            assert [r.payload_bytes for r in got if r.page_id in (None, 91)] == [0, 0, 0]


def test_archive_dictionary_and_damage():
    import io

    samples = [b"<html><body>%d common words here</body></html>" % i for i in range(2000)]
    dictionary = zstandard.train_dictionary(4096, samples)
    packer = zstandard.ZstdCompressor(dict_data=dictionary)
    record = warc.record_bytes(1, "u", samples[0], "response", None)
    head = struct.pack("<II", warc.DICTIONARY_MAGIC, len(dictionary.as_bytes())) + dictionary.as_bytes()
    archive = head + packer.compress(record) + packer.compress(record)
    assert list(warc.read_frames(io.BytesIO(archive))) == [record, record]
    assert warc.parse_record(record)["payload"] == samples[0]
    for bad in (archive[:-3], head + b"abcdefgh", archive[:20]):
        with pytest.raises((warc.BadArchive, zstandard.ZstdError)):
            list(warc.read_frames(io.BytesIO(bad)))
    for bad in (record[:-1], record.replace(b"common", b"comMon"), record.replace(b"WARC/1.1", b"WARC/9.9"), record.replace(b"Content-Length: ", b"Content-Length: 1", 1)):
        with pytest.raises(warc.BadArchive):
            warc.parse_record(bad)


PII = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(map(int, reversed(d)))) % 10 == 0


def test_personal_data_equals_plain_patterns(spark):
    rng = random.Random(6)
    odd = ["é a.b@c.d_e@f.g x", "1.2.3.4.5 256.1.1.1 0001.2.3.4", "4041894974608795 4041 8949-7460 8795", "+1 (386) 555-3733 +12", "@", "+1" * 30, "a." * 3000 + "@b.c", "9" * 9000, "x@" + "y." * 3000 + "z"]
    odd += ["".join(rng.choice("ab1234567890.@+- ()é\n") for _ in range(300)) for _ in range(40)]
    texts = [*enumerate(odd), (100, None), (101, ""), (102, odd[0]), (102, odd[0]), (None, odd[1])]
    check = {
        "email": lambda v: True,
        "ip": lambda v: all(int(x) <= 255 for x in v.split(".")),
        "card": lambda v: 14 <= len(d := re.sub("[^0-9]", "", v)) <= 19 and luhn(d),
        "phone": lambda v: 10 <= len(re.sub("[^0-9]", "", v)) <= 15,
    }
    found = sanitise.find_personal(docs_of(spark, texts)).select("row.doc_id", sanitise.written(F.col("base")).alias("b")).collect()

    def plain(text):
        spans = [(m.start(), k, m.end(), n) for k, (n, p) in enumerate(PII.items()) for m in re.finditer(p, text or "") if check[n](m[0])]
        return ",".join(f"{n}:{s}:{e}" for s, _, e, n in sorted(spans))

    assert sorted((r.doc_id is None, r.doc_id, r.b) for r in found if r.doc_id is not None) == sorted((False, i, plain(t)) for i, t in texts if i is not None)
    assert len(found) == len(texts)
    assert sanitise.find_personal(docs_of(spark, [])).count() == 0


def test_disclosing_term_is_taken_out(spark):
    rng = random.Random(8)
    noise = [(i, words_of(rng, 30)) for i in range(50)]
    near = [(100 + i, f"{words_of(rng, 6)} alpha{'abcdefgh'[i]} Rosalind beta{'abcdefgh'[i]} ann@ex.org {words_of(rng, 6)}") for i in range(6)]
    copies = [(200 + i, f"some fixed words Humphrey and more bob@ex.org {i}") for i in range(6)]
    docs = docs_of(spark, noise + near + copies)
    got = {r.doc_id: r.text for r in sanitise.sanitise(docs).collect()}
    assert all("Rosalind" not in got[100 + i] and "<EMAIL>" in got[100 + i] for i in range(6))
    assert all("Humphrey" in got[200 + i] and "bob@" not in got[200 + i] for i in range(6))
    assert all(got[i] == t for i, t in noise) and sanitise.sanitise(docs).columns == docs.columns


def test_pieces_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = ["", "  ", " a  b ", "x\n\ny", "Héllo  wörld ☃\n x", "中文字符測試", "a" * 300, "=" * 100 + " ----", "\t\x00 a", "🎉🎉 ok", "</s> <0x41>", " ", "the the"]
    docs = docs_of(spark, [*enumerate(texts), (99, None), (None, "a")])
    coded = pieces.encode(docs, MODEL, keep=["doc_id"], verify=True)
    got = {r.doc_id: r for r in coded.collect()}
    assert all(got[i].piece_ids == library.encode(t) for i, t in enumerate(texts)) and got[99].piece_ids is None
    assert all(r.round_trip for r in got.values())
    back = {r.doc_id: r.text for r in pieces.decode(coded, MODEL, keep=["doc_id"]).collect()}
    assert all(back[i] == t for i, t in enumerate(texts)) and back[99] is None
    assert pieces.encode(docs.limit(0), MODEL, keep=["doc_id"]).count() == 0


def test_language_shares(spark):
    rng = random.Random(9)
    sounds = {"aa": ["ka", "ro", "mi", "ta"], "bb": ["sch", "un", "der", "ei"], "cc": ["qu", "eau", "oix", "le"]}
    say = lambda lang, n: " ".join("".join(rng.choice(sounds[lang]) for _ in range(3)) for _ in range(n))
    rows = [(i, say(l, 40), l, "s", 1, 1, 2, 3) for i, l in enumerate(["aa", "bb", "cc"] * 40)]
    rows += [(1000, None, "aa", "s", 1, 1, 2, 3), (1001, "123 !!", "aa", "s", 1, 1, 2, 3), (1002, say("aa", 60) + " " + say("bb", 30), None, "s", 1, 1, 2, 3), (None, "k", "aa", "s", 1, 1, 2, 3)]
    docs = spark.createDataFrame(rows, DOCS)
    held = language.in_fold("doc_id", 5, 0)
    model = language.learn(docs, "text", "lang", ~held)
    got = {r.doc_id: r for r in language.identify(docs, model, keep=["doc_id", "id"]).collect()}
    assert all(got[r[0]].lang_pred == r[2] for r in rows[:120])
    assert (got[1000].lang_pred, got[1001].lang_pred) == ("und", "und") and got[1001].score == 0
    assert got[1002].languages == ["aa", "bb"] and 0.5 < got[1002].score < 0.8
    assert language.identify(docs.limit(0), model, keep=["doc_id"]).count() == 0


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    texts = [(i, t) for i, t in near_texts() if i is not None][:250] + [(8000, "mail me at a.b@c.org now please"), (8001, "12 34 --")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    kept = [(i, t) for i, t in texts if t and any(map(str.isalpha, t))]
    first = {i for i, _, c in brute_components(kept) if i == c}
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} == first and 8001 not in first
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_copies", "personal_data", "packing"]

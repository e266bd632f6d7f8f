"""Registered queries of the language-model operators, and SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metropulse.llm import (
    brown,
    language,
    nn_descent,
    packing,
    periodic,
    pieces,
    posting_lists,
    sanitise,
    token_counts,
    token_files,
    turns,
    warc,
)
from metropulse.llm.ngram_join import ngram_jaccard_components
from metropulse.operators.staging import settle, shared_folder


#: Folder of public vocabulary files, the same on every executor.
TOKENIZERS = "/opt/tokenizers"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_pack(_table(spark, sf_dir, "documents"), packing.word_tokens(F.col("text")))


def op2_token_counts(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    import public_tokenizers

    vocabulary = f"{tokenizers}/byte_bpe_50k.tiktoken"
    docs = _table(spark, sf_dir, "documents").select("text")
    return token_counts.length_histogram(token_counts.encoded_lengths(docs, vocabulary, public_tokenizers.PATTERN))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_components(_table(spark, sf_dir, "documents"))


def op4_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language.in_fold("doc_id", 7, 2)
    model = brown.fit(docs.where(~held_out).select("text"))
    return brown.score_texts(docs, model, "doc_id", "text", held_out)


def op5_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = shared_folder(spark, "warc")
    written = warc.write_archives(warc.plan_records(pages), folder, warc.train_dictionary(pages))
    manifest = settle(written, "warc-manifest")
    read = warc.read_archives(manifest.df, manifest.rows, payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find_personal(_table(spark, sf_dir, "documents"))
    base = F.col("base")

    def times(kind: int) -> Column:
        return F.size(F.filter(base, lambda x: x["k"] == kind)).cast("long")

    counts = [times(k).alias(f"n_{name}") for k, name in enumerate(sanitise.KINDS)]
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *counts,
        F.sha2(sanitise.written(base), 256).alias("base_sha256"),
        sanitise.written(F.col("spans")).alias("spans"),
    )


def op8_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posting_lists.nearest_by_product(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op9_sentencepiece(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pieces.encode(docs, f"{tokenizers}/piece_bpe_32k.model", keep=["doc_id"], verify=True)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = language.in_fold("doc_id", 5, 0)
    model = language.learn(docs, "text", "lang", ~held_out)
    named = language.identify(docs, model, keep=["doc_id"])
    return named.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


def planted_repeats(text: Column, doc_id: Column) -> Column:
    """The text, of every tenth document by a hash of its id from some word on the same few words again and again."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[ \\t-\\r]+"), lambda w: w != "")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        numbers = F.sequence(F.lit(0).cast("long"), n - 1)
        named = F.transform(numbers, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n == 0, F.lit("")).otherwise(F.array_join(named, " "))

    # A one-element array names the words, so that they are cut once.
    return F.when(h % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    read = docs.select("doc_id", planted_repeats(F.coalesce("text", F.lit("")), F.col("doc_id")).alias("text"))
    found = periodic.periodic_runs(read, keep=["doc_id"])
    # Greatest exact length / period first: fractions are compared by their products, which fit 64 bits.
    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        earlier = (a["start"] < b["start"]) | ((a["start"] == b["start"]) & (a["period"] < b["period"]))
        return F.when(left > right, F.lit(-1)).when(left < right, F.lit(1)).when(earlier, F.lit(-1)).otherwise(F.lit(1))

    best = F.get(F.array_sort("runs", order), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select("doc_id", "runs", "collapsed", best.alias("best"), listed.alias("listed")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000L * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("listed").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    repaired = turns.repair(turns.damaged(table))
    return turns.with_all(table, repaired)


def op13_token_files(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    written = token_files.write_token_files(docs, shared_folder(spark, "tokens"), f"{tokenizers}/byte_bpe_50k.json")
    manifest = settle(written, "tokens-manifest")
    read = token_files.read_token_files(manifest.df, manifest.rows)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = [
    op1_best_fit_packing,
    op2_token_counts,
    op3_ngram_jaccard_join,
    op4_class_model,
    op5_nn_descent,
    op6_warc,
    op7_personal_data,
    op8_posting_lists,
    op9_sentencepiece,
    op10_language,
    op11_periodic_runs,
    op12_conversation_repair,
    op13_token_files,
]


def class_model_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of ``op4_class_model`` that SQL can tell: counts and the base score."""
    scored = op4_class_model(spark, sf_dir)
    rounded = F.round("base_score", 4)
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", rounded.alias("base_score"))


def personal_data_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of ``op7_personal_data``; places are beyond the reach of SQL."""
    return op7_personal_data(spark, sf_dir).select("doc_id", *[f"n_{k}" for k in sanitise.KINDS])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: q for q in [*QUERIES, class_model_base, personal_data_counts]}


# Words as the operators read them: runs of anything but space and 0x09-0x0D, A-Z lower-cased.
_WORDS = r"""
    SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents"""

# CRC-32 of a number as text, bit by bit.
_CRC = """
    xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len({s}) + 1), lambda i: CAST(ord({s}[i]) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), list_transform(range(8), lambda j: CAST(0 AS BIGINT))),
            lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""

SQL = {
    "op6_warc": """
        WITH paid AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        sized AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, payload_digest FROM paid),
        led AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS leader FROM sized)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> leader THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> leader THEN leader END AS refers_to
        FROM led""",
    "class_model_base": f"""
        WITH worded AS ({_WORDS}),
        folds AS (SELECT doc_id, words, {_CRC.format(s="CAST(doc_id AS VARCHAR)")} % 7 = 2 AS held_out FROM worded),
        train AS (SELECT unnest(words) AS w FROM folds WHERE NOT held_out),
        counts AS (SELECT w, count(*) AS c FROM train GROUP BY 1),
        ends AS (SELECT count(*) AS c FROM folds WHERE NOT held_out),
        totals AS (SELECT (SELECT sum(c) FROM counts) + ends.c AS n, (SELECT count(*) FROM counts) + 1 AS v, ends.c AS e FROM ends),
        tokens AS (SELECT doc_id, unnest(words) AS w FROM folds),
        sums AS (SELECT doc_id, count(*) AS k, count(c) AS known, sum(log10((coalesce(c, 0) + 1) / CAST(n + v + 1 AS DOUBLE))) AS s
                 FROM tokens LEFT JOIN counts USING (w), totals GROUP BY 1)
        SELECT doc_id, held_out, coalesce(k, 0) + 1 AS n_tokens, coalesce(known, 0) + CAST(e > 0 AS INTEGER) AS n_known,
               CAST(n AS BIGINT) AS train_tokens,
               round(coalesce(s, 0) + log10((e + 1) / CAST(n + v + 1 AS DOUBLE)), 4) AS base_score
        FROM folds LEFT JOIN sums USING (doc_id), totals""",
    "personal_data_counts": r"""
        WITH hits AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+') AS emails,
                 regexp_extract_all(coalesce(text, ''), '[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)') AS ips,
                 list_transform(regexp_extract_all(coalesce(text, ''), '[0-9]([ -]?[0-9])+'),
                                lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS cards,
                 list_transform(regexp_extract_all(coalesce(text, ''), '\+[0-9][ ().0-9-]+[0-9]'),
                                lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS phones
          FROM documents)
        SELECT doc_id, CAST(len(emails) AS BIGINT) AS n_email,
               CAST(len(list_filter(ips, lambda x: len(list_filter(string_split(x, '.'), lambda p: len(ltrim(p, '0')) > 3
                 OR CAST(CASE WHEN len(ltrim(p, '0')) BETWEEN 1 AND 3 THEN ltrim(p, '0') ELSE '0' END AS INTEGER) > 255)) = 0)) AS BIGINT) AS n_ip,
               CAST(len(list_filter(cards, lambda x: len(x) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, len(x) + 1),
                 lambda i: CASE WHEN i % 2 = 1 THEN CAST(x[len(x) - i + 1] AS INTEGER)
                   ELSE (CAST(x[len(x) - i + 1] AS INTEGER) * 2) // 10 + (CAST(x[len(x) - i + 1] AS INTEGER) * 2) % 10 END)) % 10 = 0)) AS BIGINT) AS n_card,
               CAST(len(list_filter(phones, lambda x: len(x) BETWEEN 10 AND 15)) AS BIGINT) AS n_phone
        FROM hits""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)

"""Exact histogram of encoded lengths, and what suffix sums of it tell about every context limit."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metropulse.operators.staging import settle

#: Lengths of one block of the histogram's prefix sums; a longest length of millions is a few thousand blocks.
BLOCK = 1024


@cache
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encoded_lengths(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens in place of the text, counted with the byte-level ranks in the file ``vocabulary``, which every
    executor has at that path. Null and empty texts have 0 tokens; strings of special tokens are ordinary text; a text is encoded
    whole and once, however long. A column n_tokens that was there gives way. Every row comes back, repeated rows too."""
    kept = [c for c in docs.columns if c not in (text_col, "n_tokens")]
    n = len(kept)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(vocabulary, pattern).encode_ordinary
        for batch in batches:
            lengths = [len(encode(t)) if t else 0 for t in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(lengths, pa.int64())], [f"c{i}" for i in range(n + 1)])

    # A map over batches is evaluated once, where a function in an expression would be again in filters and groupings.
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string"))
    source = source.toDF(*[f"c{i}" for i in range(n)], "text")
    kinds = [f"c{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])]
    return source.mapInArrow(count, ", ".join([*kinds, f"c{n} long"])).toDF(*kept, "n_tokens")


def length_histogram(lengths: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """For every length that occurs: n_docs, docs_from and tokens_from (suffix sums: documents at least that long and their
    tokens), docs_upto (prefix sum), truncated_tokens (all tokens when texts are cut at that length) and total_tokens.

    Sums run within blocks of ``BLOCK`` lengths and over the blocks' totals, so no task sorts the whole histogram. Null
    lengths are left out; an empty table gives no rows.
    """
    n = F.col(f"`{length_col}`").cast("long")
    counted = lengths.groupBy(n.alias("n_tokens")).agg(F.count("*").alias("n_docs"))
    # The counts are read twice below; written once, nothing before them runs again.
    counted = settle(counted, "token-lengths").df.where(F.col("n_tokens").isNotNull())
    tokens = F.col("n_tokens") * F.col("n_docs")
    counted = counted.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn("tokens", tokens)
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = counted.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    # One row per block of lengths, whatever the number of documents.
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("d_after"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("t_after"),
        F.sum("d").over(Window.partitionBy(F.lit(1))).alias("all_docs"),
        F.sum("t").over(Window.partitionBy(F.lit(1))).alias("total_tokens"),
    )
    summed = counted.withColumns(
        {"docs_in": F.sum("n_docs").over(inside), "tokens_in": F.sum("tokens").over(inside)}
    ).join(blocks, "block")
    docs_from, tokens_from = F.col("docs_in") + F.col("d_after"), F.col("tokens_in") + F.col("t_after")
    return summed.select(
        "n_tokens",
        "n_docs",
        docs_from.alias("docs_from"),
        tokens_from.alias("tokens_from"),
        (F.col("all_docs") - docs_from + F.col("n_docs")).alias("docs_upto"),
        (F.col("total_tokens") - tokens_from + F.col("n_tokens") * docs_from).alias("truncated_tokens"),
        "total_tokens",
    )


def quantile(histogram: DataFrame, q: float) -> DataFrame:
    """The least length that at least the share ``q`` of the documents do not exceed, as one row."""
    docs = F.col("docs_upto") + F.col("docs_from") - F.col("n_docs")
    return histogram.where(F.col("docs_upto") >= q * docs).agg(F.min("n_tokens").alias("length"))


def at_limit(histogram: DataFrame, limit: int) -> DataFrame:
    """Tokens left when every text is cut at ``limit``, which need not occur as a length, as one row."""
    up = F.when(F.col("n_tokens") <= limit, F.col("n_tokens")).otherwise(F.lit(limit))
    return histogram.agg(F.coalesce(F.sum(up * F.col("n_docs")), F.lit(0)).alias("tokens"))

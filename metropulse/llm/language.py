"""Language of documents as a mixture: expectation-maximisation of language shares over letter trigrams.

Each language is a distribution over hashed byte trigrams of letters, learned from labelled documents. A document's
trigrams are drawn from a mixture of languages; EM finds the shares. Languages enter the reported set in order of share as
long as the log-likelihood gained by one more exceeds ``PENALTY * ln(trigrams)``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metropulse.llm.words import mix, slices, text_bytes

FEATURES = 1 << 15
#: About so many different labelled texts of each language, chosen by a hash of the text, are learned from.
MAX_TRAIN = 10_000
SMOOTHING = 0.5
PENALTY = 1.0
LEAST_SHARE = 0.02
ROUNDS = 8
UNKNOWN = "und"

_FOLD = np.zeros(256, dtype=np.uint8)  # 0 is anything but a letter
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def trigram_counts(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, feature and count of every distinct trigram feature, by row."""
    raw, at = text_bytes(column)
    b = _FOLD[raw]
    row = np.repeat(np.arange(len(at) - 1, dtype=np.int64), np.diff(at))
    keep = np.ones(len(b), dtype=bool)
    keep[1:] = (b[1:] != 0) | (b[:-1] != 0)
    b, row = b[keep].astype(np.uint64), row[keep]
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (b[:-2] << np.uint64(16)) | (b[1:-1] << np.uint64(8)) | b[2:]
    fits = (row[:-2] == row[2:]) & (b[1:-1] != 0)
    feature = (mix(code[fits]) % np.uint64(FEATURES)).astype(np.int64)
    key = row[:-2][fits] * FEATURES + feature
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(key)))
    return key[first] // FEATURES, key[first] % FEATURES, counts


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for a, b in slices(batch.column(0)):
            part = batch.slice(a, b - a)
            row, feature, count = trigram_counts(part.column(0))
            langs = np.array(part.column(1).to_pylist(), dtype=object)
            for lang in set(langs.tolist()):
                mine = (langs == lang)[row]
                sums.setdefault(lang, np.zeros(FEATURES, dtype=np.int64))
                sums[lang] += np.bincount(feature[mine], count[mine], FEATURES).astype(np.int64)
    for lang, n in sums.items():
        f = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(f)), pa.array(f), pa.array(n[f])], ["lang", "f", "n"])


class Mixture:
    """Likelihoods of features by language and EM over slices of documents."""

    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs = langs
        smooth = counts + SMOOTHING
        self.p = (smooth / smooth.sum(axis=0)).astype(np.float32)

    def _em(self, x, row, count, starts, shares, rounds):
        total = np.add.reduceat(count, starts)
        for _ in range(rounds):
            parts = x * shares[row]
            parts *= (count / parts.sum(axis=1))[:, None]
            shares = np.add.reduceat(parts, starts, axis=0) / total[:, None]
        fit = np.log(np.maximum((x * shares[row]).sum(axis=1), 1e-30)) * count
        return shares, np.add.reduceat(fit, starts)

    def shares(self, column: pa.Array) -> np.ndarray:
        """Language shares of each row; zeros where there is no trigram."""
        row, feature, count = trigram_counts(column)
        out = np.zeros((len(column), len(self.langs)))
        if not len(row) or not self.langs:
            return out
        docs, starts = np.unique(row, return_index=True)
        which = np.repeat(np.arange(len(docs)), np.diff(np.append(starts, len(row))))
        x, count = self.p[feature], count.astype(np.float32)
        k = len(self.langs)
        flat = np.full((len(docs), k), 1 / k, dtype=np.float32)
        full, _ = self._em(x, which, count, starts, flat, ROUNDS)
        order = np.argsort(-full, axis=1, kind="stable")
        price = PENALTY * np.log(np.add.reduceat(count, starts) + 1)
        # One language, then one more as long as the gain pays for it.
        best = np.zeros((len(docs), k), dtype=np.float32)
        best[np.arange(len(docs)), order[:, 0]] = 1
        fit = np.add.reduceat(np.log(x[np.arange(len(x)), order[which, 0]]) * count, starts)
        open_ = np.arange(len(docs))
        for size in range(2, k + 1):
            open_ = open_[full[open_, order[open_, size - 1]] >= LEAST_SHARE]
            if not len(open_):
                break
            inside = np.zeros(len(docs), dtype=bool)
            inside[open_] = True
            take = inside[which]
            small = np.repeat(np.arange(len(open_)), np.diff(np.append(starts, len(which)))[open_])
            at = np.flatnonzero(np.append(True, small[1:] != small[:-1]))
            allowed = np.zeros((len(open_), k), dtype=np.float32)
            np.put_along_axis(allowed, order[open_, :size], 1, axis=1)
            begin = full[open_] * allowed + allowed * np.float32(1e-3)
            begin /= begin.sum(axis=1)[:, None]
            got, reached = self._em(x[take], small, count[take], at, begin.astype(np.float32), ROUNDS)
            pays = reached - fit[open_] > price[open_]
            best[open_[pays]], fit[open_[pays]] = got[pays], reached[pays]
            open_ = open_[pays]
        out[docs] = best
        return out


def learn(docs: DataFrame, text_col: str, lang_col: str, training: Column, max_train: int = MAX_TRAIN) -> Mixture:
    """Trigram counts of the labelled documents that ``training`` holds for. Of a language with more than ``max_train`` different
    texts about that many are taken, by a hash of the text; every language is learned, and copies of a text count once.
    The model is langs x FEATURES numbers, so the languages are few enough to be collected."""
    text, lang = F.col(f"`{text_col}`").cast("string"), F.col(f"`{lang_col}`").cast("string")
    labelled = docs.where(training & lang.isNotNull() & text.isNotNull()).select(lang.alias("lang"), text.alias("text"))
    labelled = labelled.withColumn("h", F.xxhash64("text"))
    texts = labelled.select("lang", "h").distinct().groupBy("lang").count().where(F.col("count") > max_train)
    share = {r["lang"]: max_train / r["count"] for r in texts.collect()}
    if share:
        bound = F.create_map(*[F.lit(x) for k, v in share.items() for x in (k, int((1 << 30) * v))])
        within = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(1 << 30)) < F.coalesce(F.try_element_at(bound, F.col("lang")), F.lit(1 << 30))
        labelled = labelled.where(within)
    labelled = labelled.groupBy("lang", "h").agg(F.min("text").alias("text"))
    counted = labelled.select("text", "lang").mapInArrow(_gather, "lang string, f long, n long")
    found = counted.groupBy("lang", "f").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.zeros((FEATURES, len(langs)))
    counts[found["f"].to_numpy(), found["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=int)] = found["n"]
    return Mixture(langs, counts)


def _predict(model: Mixture, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(place)):
                part = batch.slice(a, b - a)
                texts = part.column(place)
                shares = model.shares(texts)
                langs, scores, sets = [], [], []
                raw, at = text_bytes(texts)
                plain = np.add.reduceat(np.append((_FOLD[raw] > 0) & (raw < 128), False), np.minimum(at[:-1], len(raw)))
                plain = np.where(np.diff(at) > 0, plain, 0)
                for i, share in enumerate(shares):
                    letters = plain[i] or any(map(str.isalpha, texts[i].as_py() or ""))
                    if not letters or not model.langs:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        sets.append([])
                        continue
                    if not share.any():
                        share = np.full(len(share), 1 / len(share))
                    top = int(np.argmax(share))
                    langs.append(model.langs[top])
                    scores.append(min(1.0, float(share[top])))
                    sets.append([model.langs[j] for j in np.argsort(-share, kind="stable") if share[j] > 0])
                columns = [
                    *part.columns[:place],
                    *part.columns[place + 1 :],
                    pa.array(langs, pa.string()),
                    pa.array(scores, pa.float64()),
                    pa.array(sets, pa.list_(pa.string())),
                ]
                yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])

    return run


def in_fold(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    text = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(folds)) == fold


def identify(docs: DataFrame, model: Mixture, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (default: none) with lang_pred, score and languages (the chosen set, largest share first).

    ``und`` with score 0 where the text is null or has no letter. Letters too few for a trigram give equal shares and the
    first language. Rows come back as often as they went in.
    """
    keep = keep or []
    source = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string"))
    source = source.toDF(*[f"c{i}" for i in range(len(keep))], "text")
    kinds = [f"c{i} {t}" for i, (_, t) in enumerate(source.dtypes[:-1])]
    n = len(keep)
    out = [f"c{n} string", f"c{n + 1} double", f"c{n + 2} array<string>"]
    named = source.mapInArrow(_predict(model, n), ", ".join(kinds + out))
    return named.toDF(*keep, "lang_pred", "score", "languages")

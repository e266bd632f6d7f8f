"""Personal data: spans of fixed kinds, and terms that give a protected value away by how the corpus uses them.

Built-in functions only. The base kinds are patterns with checks. Each distinct valid value is a protected entity. A term is a word or a
run of up to ``LONGEST_RUN`` words; it is measured over whole distinct texts by pointwise mutual information
``PMI = log2(n_te * N / (n_t * n_e))`` against the entity's own information ``IC = log2(N / n_e)``: N texts, n_e with the entity, n_t with
the term, n_te with both, wherever in the text. A term whose PMI reaches ``DISCLOSURE * IC`` discloses the entity: in texts that hold
the entity it is generalised to a tag, or removed when it occurs nowhere without the entity (PMI = IC). A run counts only where
neither its beginning nor its end already discloses the entity.

Evidence must come from different texts. Copies, exact or near, share most of their five-word shingles, so texts are classed by their
least shingle hash, and the evidence of n texts is n over the largest class (the median of ``ORDERS`` hash orders): a thousand near copies weigh little more than one text,
a thousand letters a thousand. An entity and a pair need evidence of ``SUPPORT`` at least, and the pair's evidence times its PMI must
beat chance over all pairs looked at (``log2(pairs) + MARGIN`` bits). Entities in fewer than ``SUPPORT`` different texts therefore keep
their neighbours: nothing can be estimated for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metropulse.operators.staging import join_sized, settle

SUPPORT = 3
DISCLOSURE = 0.8
LONGEST_RUN = 4
MARGIN = 3.0
SHINGLE = 5
ORDERS = 15
#: Elements whose running sums are made one from another; the sums of blocks come first.
SUM_BLOCK = 64

KINDS = ["email", "ip", "card", "phone"]

# The patterns of the base kinds. Repeats that nothing after them can give back are possessive, which keeps
# the matches and neither recurses nor backtracks. A match can only begin where a run of its characters begins or where
# the last match ended.
_LOCAL = r"[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_SPAN = "array<struct<s:int,k:int,e:int,v:string>>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
    "card": lambda v: F.when(F.length(_digits(v)).between(14, 19), _luhn(_digits(v))).otherwise(False),
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}
HINTS = {
    "email": lambda t: t.contains("@"),
    "ip": lambda t: t.rlike("[0-9]"),
    "card": lambda t: t.rlike("[0-9]"),
    "phone": lambda t: t.contains("+"),
}


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _running(values: Column, merge: Callable[[Column, Column], Column], none: int) -> Column:
    """For each of an array of longs what ``merge`` makes of those before it: within its block, and of whole blocks before. No step
    copies what the steps before it made, as gathering in an aggregate would."""
    zero = F.lit(none).cast("bigint")

    def fold(part: Column) -> Column:
        return F.aggregate(part, zero, merge)

    def upto(n: Column) -> Column:
        return F.sequence(F.lit(0), n - 1)

    def of(v: Column) -> Column:
        blocks = F.ceil(F.size(v) / SUM_BLOCK).cast("int")
        sums = F.transform(upto(blocks), lambda b: fold(F.slice(v, b * SUM_BLOCK + 1, F.lit(SUM_BLOCK))))
        before = _bound(sums, lambda x: F.transform(upto(blocks), lambda b: fold(F.slice(x, F.lit(1), b))))

        def at(b: Column, i: Column) -> Column:
            block = F.floor(i / SUM_BLOCK).cast("int")
            return merge(F.get(b, block), fold(F.slice(v, block * SUM_BLOCK + 1, i - block * SUM_BLOCK)))

        placed = _bound(before, lambda b: F.transform(upto(F.size(v)), lambda i: at(b, i)))
        return F.when(F.size(v) > 0, placed).otherwise(F.array().cast("array<bigint>"))

    return _bound(values, of)


def _spans(text: Column, kind: str) -> Column:
    """Valid matches with code-point places: the pieces between matches and the matches take turns."""
    pattern, k = PATTERNS[kind], KINDS.index(kind)
    hits, pieces = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    turns = F.zip_with(
        hits,
        pieces,
        lambda hit, gap: F.when(hit.isNotNull(), F.struct(F.length(gap).cast("bigint").alias("gap"), F.length(hit).cast("bigint").alias("long"), hit.alias("v"))),
    )

    def place(turn: Column, before: Column) -> Column:
        s = (before + turn["gap"]).cast("int")
        return F.struct(s.alias("s"), F.lit(k).alias("k"), (s + turn["long"]).cast("int").alias("e"), turn["v"].alias("v"))

    def placed(t: Column) -> Column:
        sums = _running(F.transform(t, lambda x: x["gap"] + x["long"]), lambda a, b: a + b, 0)
        return F.zip_with(t, sums, place)

    found = _bound(F.filter(turns, lambda x: x.isNotNull()), placed)
    none = F.array().cast(_SPAN)
    return F.when(HINTS[kind](text), F.filter(found, lambda x: CHECKS[kind](x["v"])).cast(_SPAN)).otherwise(none)


def base_spans(text: Column) -> Column:
    """All valid base spans by start, then kind."""
    return F.array_sort(F.concat(*[_spans(text, k) for k in KINDS]))


def _words(text: Column) -> Column:
    """The letter runs of a text, lower-cased."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def _word_rows(texts: DataFrame, longest: int) -> DataFrame:
    """(h1, h2, i, w0 ... ): every word of the texts (t) with those after it, ``longest`` in all; null past the end."""
    words = texts.select(*_key(F.col("t")), _words(F.col("t")).alias("w"))
    shifted = [F.col("w"), *[F.slice("w", F.lit(n + 1), F.greatest(F.size("w") - n, F.lit(0))) for n in range(1, longest)]]
    rows = words.select("h1", "h2", F.posexplode(F.arrays_zip(*[x.alias(f"w{n}") for n, x in enumerate(shifted)])).alias("i", "x"))
    return rows.select("h1", "h2", "i", *[F.col(f"x.w{n}").alias(f"w{n}") for n in range(longest)])


def _run_of(words: list[Column]) -> Column:
    """Words joined by a space; null if one is missing."""
    return F.concat(*[x for w in words for x in (F.lit(" "), w)][1:])


def _classes(text: Column) -> Column:
    """The least hash of a text's five-word shingles (of all its words if they are fewer) in each of ``ORDERS`` orders."""

    def of(words: Column) -> Column:
        n = F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))
        return F.transform(F.sequence(F.lit(1), n), lambda i: F.xxhash64(F.array_join(F.slice(words, i, F.lit(SHINGLE)), " ")))

    def least(hashes: Column) -> Column:
        return F.array(*[F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(seed)))) for seed in range(ORDERS)])

    whole = F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return _bound(_bound(whole, of), least)


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2")]


def _owned(found: DataFrame) -> DataFrame:
    """(h1, h2, k, v): which text holds which entity."""
    each = found.select("h1", "h2", F.explode("spans").alias("x"))
    return each.select("h1", "h2", F.col("x.k").alias("k"), F.lower("x.v").alias("v")).distinct()


def _evidence(rows: DataFrame, by: list[str], total: str) -> DataFrame:
    """Texts (as ``total``) and their evidence by ``by``, of rows that are one per text, with its classes; enough of it only.
    In one order a line that texts have in common can have the least hash and put them in one class, or near copies can differ in it;
    over many orders the median follows the share of shingles in common."""
    each = rows.select(*by, F.posexplode("classes").alias("order", "class"))
    classes = each.groupBy(*by, "order", "class").agg(F.count("*").alias("n"))
    orders = classes.groupBy(*by, "order").agg(F.sum("n").alias("n"), (F.sum("n") / F.max("n")).alias("evidence"))
    sums = orders.groupBy(*by).agg(F.max("n").alias(total), F.median("evidence").alias("evidence"))
    return sums.where(F.col("evidence") >= SUPPORT)


def disclosing_terms(texts: DataFrame, found: DataFrame) -> DataFrame | None:
    """(k, v, term, words, sure) for terms that disclose the entity (k, v); None where there is no evidence for any.

    ``texts`` has the column t, all texts; ``found`` has the texts with spans once each, as h1, h2, t, spans.
    """
    classed = found.select("h1", "h2", _classes(F.col("t")).alias("classes"))
    owned = settle(_owned(found).join(classed, ["h1", "h2"]), "pii-owned").df
    entity = settle(_evidence(owned, ["k", "v"], "n_e").drop("evidence"), "pii-entities")
    if not entity.rows:
        return None
    total = float(texts.select(*_key(F.col("t"))).distinct().count())
    owned = settle(join_sized(owned, entity, ["k", "v"], "inner", "pii-held"), "pii-holders").df
    held = settle(owned.select("h1", "h2").distinct(), "pii-texts")
    text_key = ["h1", "h2"]
    said = settle(_word_rows(join_sized(found.select(*text_key, "t"), held, text_key, "inner").select("t"), 1), "pii-said").df
    # A run can only be in SUPPORT texts with an entity if each of its words is, so the other words go first.
    once = said.select(*text_key, "w0").distinct().join(owned.select(*text_key, "k", "v"), text_key)
    often = settle(once.groupBy("k", "v", "w0").agg(F.count("*").alias("n")).where(F.col("n") >= SUPPORT).drop("n"), "pii-often")
    words = join_sized(said.join(owned.select(*text_key, "k", "v"), text_key), often, ["k", "v", "w0"], "inner")
    order = Window.partitionBy(*text_key, "k", "v").orderBy("i")
    runs = []
    for n in range(LONGEST_RUN):
        whole = _run_of([F.lead("w0", j).over(order) if j else F.col("w0") for j in range(n + 1)])
        runs.append(F.when(F.lead("i", n).over(order) == F.col("i") + n, whole) if n else F.col("w0"))
    each = words.select(*text_key, "k", "v", F.array(*runs).alias("runs")).select(*text_key, "k", "v", F.explode("runs").alias("term"))
    each = settle(each.where("term is not null").distinct(), "pii-runs").df
    counts = each.groupBy("k", "v", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= SUPPORT)
    # A term is in at least as many texts as among those at hand, which leaves out most before the corpus is asked.
    least = each.select(*text_key, "term").distinct().groupBy("term").agg(F.count("*").alias("n_f"))
    ic = F.log2(F.lit(total) / F.col("n_e"))
    rated = counts.join(entity.df, ["k", "v"]).join(least, "term").withColumn("ic", ic)
    rated = settle(rated.where((F.col("ic") > 0) & (_pmi("n_f", total) >= DISCLOSURE * F.col("ic"))), "pii-rated")
    classes = owned.select(*text_key, "k", "v", "classes")
    backed = join_sized(each, rated, ["k", "v", "term"], "inner").select(*text_key, "k", "v", "term").join(classes, [*text_key, "k", "v"])
    pairs = rated.df.join(_evidence(backed, ["k", "v", "term"], "n").drop("n"), ["k", "v", "term"])
    pairs = settle(pairs, "pii-terms")
    if not pairs.rows:
        return None
    wanted = pairs.df.select("term").distinct().withColumn("lead", F.substring_index("term", " ", 2))
    wanted = settle(wanted.withColumn("words", _length("term")), "pii-wanted")
    longest = wanted.df.agg(F.max("words")).first()[0]
    every = _word_rows(texts.select("t"), longest)
    # Runs are looked up by their first two words: by the first alone, a common one would meet every run that it begins.
    leads = [F.col("w0"), _run_of([F.col("w0"), F.col("w1")])] if longest > 1 else [F.col("w0")]
    every = join_sized(every.withColumn("lead", F.explode(F.array(*leads))), wanted, ["lead"], "inner")
    whole = F.element_at(F.array(*[_run_of([F.col(f"w{j}") for j in range(n + 1)]) for n in range(longest)]), F.col("words"))
    times = every.where(whole == F.col("term")).groupBy("term").agg(F.countDistinct(*text_key).alias("n_t"))
    measured = pairs.df.join(times, "term").withColumn("pmi", _pmi("n_t", total))
    chance = F.log2(F.lit(float(pairs.rows))) + MARGIN
    measured = measured.where((F.col("pmi") >= DISCLOSURE * F.col("ic")) & (F.col("evidence") * F.col("pmi") >= chance))
    kept = measured.select("k", "v", "term", _length("term").alias("words"), (F.col("n_te") >= F.col("n_t")).alias("sure"))
    told = settle(kept, "pii-disclosing")
    if not told.rows:
        return None
    shorter = told.df.select("k", "v", F.col("term").alias("part"))
    out = told.df  # runs whose beginning or end discloses by itself add nothing
    for part in (F.regexp_replace("term", " [^ ]+$", ""), F.regexp_replace("term", "^[^ ]+ ", "")):
        inner = F.when(F.col("words") > 1, part)
        out = out.withColumn("part", inner).join(shorter, ["k", "v", "part"], "left_anti").drop("part")
    return settle(out, "pii-shortest").df


def _length(term: str) -> Column:
    return F.size(F.split(term, " "))


def _pmi(n: str, total: float) -> Column:
    return F.log2(F.col("n_te") * F.lit(total) / (F.col(n) * F.col("n_e")))


def _term_spans(found: DataFrame, terms: DataFrame) -> DataFrame:
    """(h1, h2, more): places of disclosing terms in the texts that hold their entity, none that meets a base span.

    Words are rows and places running sums over a text's words; base spans and term spans are told apart in order of place, so
    no row carries a text's other words or spans.
    """
    key = ["h1", "h2"]
    wanted = _owned(found).join(terms, ["k", "v"]).groupBy(*key, "term").agg(F.max("sure").alias("sure"))
    wanted = settle(wanted, "pii-marked").df
    longest = terms.agg(F.max("words")).first()[0]
    word, text = r"\p{L}+", F.col("t")
    gaps = F.transform(F.split(text, word, -1), F.length).alias("gap")
    turns = F.arrays_zip(gaps, F.regexp_extract_all(text, F.lit(word), F.lit(0)).alias("w"))
    marked = found.join(wanted.select(*key).distinct(), key)
    words = marked.select(*key, F.posexplode(turns).alias("i", "x")).where("x.w is not null")
    order = Window.partitionBy(*key).orderBy("i")
    words = words.withColumn("e", F.sum(F.col("x.gap") + F.length("x.w")).over(order))
    words = words.select(*key, "i", F.lower("x.w").alias("w"), (F.col("e") - F.length("x.w")).alias("s"), "e")
    runs = []
    for n in range(longest):
        ends = [F.lead("w", j).over(order) if j else F.col("w") for j in range(n + 1)]
        term = F.concat(*[x for w in ends for x in (F.lit(" "), w)][1:])  # null where the text ends before the run
        runs.append(F.struct(term.alias("term"), (F.lead("e", n).over(order) if n else F.col("e")).alias("e")))
    each = words.select(*key, "s", F.array(*runs).alias("runs")).select(*key, "s", F.inline("runs")).where("term is not null")
    hits = each.join(wanted, [*key, "term"])
    kind = F.when(F.col("sure"), len(KINDS) + 1).otherwise(len(KINDS))
    hits = hits.select(*key, "s", "e", kind.alias("k"), F.col("term").alias("v"), (F.col("e") - 1).alias("at"), F.lit(None).cast("bigint").alias("base_end"))
    base = marked.select(*key, F.explode("spans").alias("x")).select(*key, "x.s", "x.e", F.lit(None).cast("int").alias("k"), F.lit(None).cast("string").alias("v"), "x.s", "x.e")
    base = base.toDF(*key, "s", "e", "k", "v", "at", "base_end")
    # A base span meets a term if it begins before the term's end and ends after the term's beginning.
    before = Window.partitionBy(*key).orderBy("at", F.col("base_end").isNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = hits.unionByName(base).withColumn("reach", F.max("base_end").over(before)).where("base_end is null")
    clear = both.where(F.coalesce(F.col("reach") <= F.col("s"), F.lit(True)))
    span = F.struct(F.col("s").cast("int").alias("s"), F.col("k").cast("int").alias("k"), F.col("e").cast("int").alias("e"), "v")
    return clear.groupBy(*key).agg(F.array_sort(F.collect_list(span)).cast(_SPAN).alias("more"))


def find_personal(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` as the struct column row, its text as t (null: empty), base spans and all spans, as arrays of
    (s, k, e, v) by start and kind: code points, end exclusive. k counts ``KINDS``, then generalised and removed terms.

    Every row comes back once, repeated rows too; an empty table gives an empty result; other columns stay in row, whatever their
    names. A text is one row's work, in time that grows little faster than its spans (``_running``).
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("t"))
    marked = rows.withColumn("base", base_spans(F.col("t")))
    has = F.size("base") > 0
    found = rows.select("t").withColumn("spans", base_spans(F.col("t"))).where(F.size("spans") > 0)
    found = found.select(*_key(F.col("t")), "t", "spans")
    # One row per text: copies hold the same spans.
    found = settle(found.groupBy("h1", "h2").agg(F.first("t").alias("t"), F.first("spans").alias("spans")), "pii-found").df
    terms = disclosing_terms(rows.select("t"), found)
    more = settle(_term_spans(found, terms), "pii-more") if terms is not None else None
    if more is None or not more.rows:
        return marked.withColumn("spans", F.col("base"))
    keyed = marked.withColumns({c: F.when(has, h) for c, h in zip(("h1", "h2"), _key(F.col("t")), strict=True)})
    joined = join_sized(keyed, more, ["h1", "h2"])
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(_SPAN))))
    return joined.select("row", "t", "base", spans.alias("spans"))


NAMES = [*KINDS, "term", "removed"]


def written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(n) for n in NAMES])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", names[x["k"]], x["s"], x["e"])), ",")


def sanitise(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with spans replaced by a tag of their kind, removed terms by nothing. Overlapping spans are replaced as one.
    Null texts stay null; rows and other columns stay as they are."""
    found = find_personal(docs, text_col)
    tags = F.array(*[F.lit(f"<{n.upper()}>") for n in NAMES[:-1]], F.lit(""))

    # What begins before the furthest end so far is already replaced.
    ends = _running(F.transform("spans", lambda x: x["e"].cast("bigint")), lambda a, b: F.greatest(a, b), 0)

    def piece(x: Column, done: Column) -> Column:
        gap = F.substring(F.col("t"), (done + 1).cast("int"), (x["s"] - done).cast("int"))
        return F.when(x["s"] >= done, F.concat(gap, tags[x["k"]])).otherwise("")

    last = F.coalesce(F.array_max(F.transform("spans", lambda x: x["e"])), F.lit(0))
    clean = F.concat(F.array_join(F.zip_with("spans", ends, piece), ""), F.substring(F.col("t"), last + 1, F.length("t")))
    kept = F.col(f"row.`{text_col}`")
    fresh = F.when(F.size("spans") > 0, clean).otherwise(kept)
    return found.select(*[(fresh.alias(c) if c == text_col else F.col(f"row.`{c}`")) for c in docs.columns])

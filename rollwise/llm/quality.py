"""Quality rules: hashed n-gram log-likelihood ratio, DataFrame functions only.

Words and word pairs are hashed into ``BUCKETS`` classes.  Two multinomials
over the classes, of the trusted target (documents with label quality 1) and
of the raw corpus (all documents), give each class a log-likelihood ratio, in
thousandths.  A document's verdict is the mean ratio of its n-grams against
one threshold for all documents: the value that all but ``TARGET_LOSS`` of
the target's own documents reach, read from a histogram of whole thousandths.
Sums and cuts are of whole numbers, so a run always gives the same verdicts.

Rules on counts come first: a document of fewer than ``LEAST_WORDS`` words, or
with more than half of its words in repeated three-word windows, fails.
Null and empty texts have no words and fail.  Without labels, or when no
target document passes the rules, the verdict is the rules' alone.
Repeated rows count and are returned as often as they occur.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from rollwise.llm.common import WS_BYTES, bind, saved, words_col

BUCKETS = 1 << 15
TARGET_LOSS = 0.02
#: The target multinomial is fitted on so many labelled documents at most, the smallest by hash of doc_id.
TARGET_ROWS = 20_000
LEAST_WORDS = 50
SMOOTHING = 1.0
FEW = 32
_POSITION_BITS = 26


def repeated_words(word_hashes: Column) -> Column:
    """Words in three-word windows that occur twice or more in the text.

    Sorted hashes show which repeat.  A text with up to ``FEW`` of these (most
    have none) looks each window up among them; one with more sorts windows as
    one integer each, high bits of the hash and below them the position, where
    equal neighbours (by the whole hash) repeat.
    """
    low = F.lit((1 << _POSITION_BITS) - 1)

    def at(x: Column) -> Column:
        return x.bitwiseAND(low).cast("int")

    def union(p: Column) -> Column:
        """Words in windows at sorted positions."""
        return F.aggregate(F.transform(p, lambda x, i: F.when(i == 0, F.lit(3)).otherwise(
            F.least(F.lit(3), x - F.get(p, F.greatest(i - 1, F.lit(0)))))), F.lit(0), lambda n, x: n + x)

    def many(hashes: Column) -> Column:
        keys = F.sort_array(F.transform(hashes, lambda h, i: h.bitwiseAND(F.bitwise_not(low)).bitwiseOR(i.cast("bigint"))))

        def equal(x: Column, other: Column) -> Column:
            return F.coalesce(F.get(hashes, at(x)) == F.get(hashes, at(other)), F.lit(False))

        return bind(keys, lambda s: F.sort_array(F.transform(F.filter(s, lambda x, i: equal(x, F.get(s, i + 1)) | (
            (i > 0) & equal(x, F.get(s, F.greatest(i - 1, F.lit(0)))))), at)))

    def covered(hashes: Column) -> Column:
        repeats = bind(F.sort_array(hashes), lambda s: F.filter(s, lambda x, i: x == F.get(s, i + 1)))
        return bind(repeats, lambda r: F.when(F.size(r) == 0, F.lit(0)).otherwise(bind(
            F.when(F.size(r) <= FEW, F.filter(F.transform(hashes, lambda x, i: F.when(F.array_contains(r, x), i)),
                                              lambda i: i.isNotNull())).otherwise(many(hashes)), union)))

    windows = F.transform(F.slice(word_hashes, 1, F.greatest(F.size(word_hashes) - 2, F.lit(0))),
                          lambda w, i: F.xxhash64(w, F.get(word_hashes, i + 1), F.get(word_hashes, i + 2)))
    return bind(windows, covered)


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def hashes(text: Column) -> Column:
    return _hashed(words_col(text))


def buckets(word_hashes: Column) -> Column:
    """Classes of the words and word pairs of a text."""
    low = F.lit(BUCKETS - 1)
    pairs = F.transform(F.slice(word_hashes, 1, F.greatest(F.size(word_hashes) - 1, F.lit(0))),
                        lambda x, i: F.xxhash64(x, F.get(word_hashes, i + 1)).bitwiseAND(low).cast("int"))
    return F.concat(F.transform(word_hashes, lambda x: x.bitwiseAND(low).cast("int")), pairs)


def counts(text: Column, table: list[int] | None) -> Column:
    """Struct of a text's counts and llr; its words are split and hashed once."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WS_BYTES.decode())) != "")
    return bind(words_col(text), lambda words: bind(_hashed(words), lambda h: F.struct(
        F.size(h).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        repeated_words(h).cast("long").alias("n_repeat_words"),
        (mean_ratio(h, table) if table else F.lit(None).cast("bigint")).alias("llr"))))


def ratios(docs: DataFrame, labels: DataFrame) -> list[int] | None:
    """Log-likelihood ratio of each class in thousandths; None without a target."""
    # TARGET_ROWS numbers at most: some 160 kB.
    trusted = F.broadcast(_trusted(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS)
                          .withColumn("trusted", F.lit(1)))
    rows = (docs.select("doc_id", "text").join(trusted, "doc_id", "left")
            .select(F.explode(bind(hashes(F.col("text")), buckets)).alias("b"), "trusted")
            .groupBy("b").agg(F.count("*").alias("raw"), F.count("trusted").alias("target")))
    p, q = np.full(BUCKETS, SMOOTHING), np.full(BUCKETS, SMOOTHING)
    for r in rows.collect():  # BUCKETS rows at most
        p[r["b"]] += r["target"]
        q[r["b"]] += r["raw"]
    if p.sum() == BUCKETS * SMOOTHING:
        return None
    return np.rint(1000 * (np.log(p / p.sum()) - np.log(q / q.sum()))).astype(int).tolist()


def mean_ratio(word_hashes: Column, table: list[int]) -> Column:
    """Mean ratio of a text's n-grams in whole thousandths, null without any."""
    literal = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")  # folded to one literal
    return bind(buckets(word_hashes), lambda b: F.when(F.size(b) > 0, F.floor(
        F.aggregate(F.transform(b, lambda x: F.get(literal, x)), F.lit(0).cast("bigint"), lambda n, x: n + x) / F.size(b))))


def _trusted(labels: DataFrame) -> DataFrame:
    return labels.where("quality = 1 and doc_id is not null").select("doc_id").distinct()


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, counts, base_failed, kept, llr."""
    table = ratios(docs, labels)
    base = docs.select("doc_id", counts(F.col("text"), table).alias("c")).select("doc_id", "c.*")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = saved(base.withColumn("base_failed", failed), "quality")
    cut = None
    if table:
        own = (scored.where(~F.col("base_failed"))
               .join(_trusted(labels), "doc_id", "left_semi")
               .groupBy("llr").count().orderBy("llr").collect())  # a row per thousandth
        lost, most = 0, TARGET_LOSS * sum(r["count"] for r in own)
        for r in own:
            if lost + r["count"] > most:
                cut = r["llr"]
                break
            lost += r["count"]
    passed = F.col("llr") >= cut if cut is not None else F.lit(True)
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(passed, F.lit(False)))

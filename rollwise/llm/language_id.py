"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams by language are gathered over all training rows (each task
adds up its own table, tables are summed by a shuffle of at most
``BUCKETS`` x languages keys), the log-probability matrix is sent to every
task and texts are scored as sparse count rows times that matrix, in numpy.

Letters are lower-cased, every other character is a boundary sign.
A null text, or one without letters, is ``und`` with score 0; so is every
text when nothing can be learned.  Rows with null lang teach nothing.  The
score is the posterior of the language named; of equal posteriors the first
language by name.  Equal texts get equal rows.
Only doc_id, text and lang of the input are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollwise.llm.common import beside, slices, utf8

BUCKETS = 1 << 16
SIZES = (1, 2, 3, 4)
SMOOTHING = 0.5
#: A pipeline keeps a text when the language named has at least this posterior.
LEAST_SCORE = 0.5


def _letter(point: int) -> int:
    """Lower-case code point of a letter, 0 of any other character."""
    c = chr(point) if point < 0x110000 else ""
    low = c.lower()
    return 0 if not c.isalpha() else ord(low) if len(low) == 1 else point


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """``_letter`` of the basic plane."""
    return np.array([_letter(i) for i in range(1 << 16)], np.uint32)


def letters_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters (0: any other character) and where each row starts."""
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    table = _letters()
    x = table[np.minimum(points, len(table) - 1)]
    if len(points) and points.max() >= len(table):
        beyond = np.flatnonzero(points >= len(table))
        each, where = np.unique(points[beyond], return_inverse=True)
        x[beyond] = np.array([_letter(int(p)) for p in each], np.uint32)[where]
    return x, np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]


def grams(x: np.ndarray, heads: np.ndarray) -> Iterator[np.ndarray]:
    """For each n the bucket of the n-gram that starts at each character;
    bucket ``BUCKETS`` where it leaves the row or starts outside a word."""
    h = np.zeros(len(x), np.uint32)
    ends = heads[1:][heads[1:] > heads[:-1]]
    for n in range(1, max(SIZES) + 1):
        m = len(x) - n + 1
        if m <= 0:
            return
        h = (h[:m] * np.uint32(0x01000193)) ^ (x[n - 1:] * np.uint32(0x9E3779B1))
        if n not in SIZES:
            continue
        out = np.full(len(x), BUCKETS, np.int32)
        out[:m] = ((h ^ np.uint32(n * 0x05EBCA6B)) * np.uint32(0xC2B2AE35)) >> np.uint32(16)
        for k in range(1, n):
            out[ends - k] = BUCKETS  # rows shorter than n mark the end of the row before, too
        if n == 1:
            out[x == 0] = BUCKETS
        yield out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, bucket, n) of a task's rows."""
    seen: dict[str, np.ndarray] = {}
    wide = BUCKETS + 1
    for batch in batches:
        raw, off = utf8(batch.column(0))
        langs = np.array(batch.column(1).to_pylist(), dtype=object)
        for i, j in slices(off):
            x, heads = letters_of(raw[off[i]:off[j]], off[i:j + 1] - off[i])
            code, names = pd.factorize(langs[i:j])
            base = np.repeat((code * wide).astype(np.int32), np.diff(heads))
            total = np.zeros(len(names) * wide, np.int64)
            for g in grams(x, heads):
                total += np.bincount(base + g, minlength=len(total))
            for name, row in zip(names, total.reshape(len(names), wide)):
                seen[name] = seen.get(name, 0) + row[:BUCKETS]
    for name, total in seen.items():
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(total[at])],
                                         names=["lang", "bucket", "n"])


class Model:
    """Languages in name order, their log priors and n-gram log probabilities."""

    def __init__(self, langs: list[str], prior: np.ndarray, matrix: np.ndarray):
        self.langs, self.prior, self.matrix = langs, prior, matrix


def train(rows: DataFrame) -> Model:
    """Fit on all rows (text, lang) with non-null lang."""
    rows = rows.where("lang is not null").select("text", "lang")
    priors = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(priors)
    counts = np.full((len(langs), BUCKETS), SMOOTHING)
    if langs:
        got = (rows.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket")
               .agg(F.sum("n").alias("n")).toArrow())  # languages x BUCKETS rows at most
        code = {k: i for i, k in enumerate(langs)}
        where = np.array([code[k] for k in got["lang"].to_pylist()], dtype=np.int64)
        counts[where, got["bucket"].to_numpy()] += got["n"].to_numpy()
    matrix = np.log(counts) - np.log(counts.sum(1, keepdims=True)) if langs else counts
    prior = np.log(np.array([priors[k] for k in langs], float) / max(1, sum(priors.values())))
    matrix = np.concatenate([matrix, np.zeros((len(langs), 1))], axis=1)  # no n-gram: no evidence
    return Model(langs, prior, matrix.astype(np.float32))


def predict(docs: DataFrame, model: Model, *carried: str) -> DataFrame:
    """carried columns, lang_pred and score of every row of ``docs``."""
    fields = [f for f in docs.select(*carried).schema]
    langs = np.array([*model.langs, "und"], dtype=object)
    prior, matrix = model.prior, model.matrix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8(batch.column(0))
            for i, j in slices(off):
                x, heads = letters_of(raw[off[i]:off[j]], off[i:j + 1] - off[i])
                n, full = j - i, np.flatnonzero(np.diff(heads))
                best, score = np.full(n, len(langs) - 1), np.zeros(n)
                if len(langs) > 1 and len(full):
                    total = np.zeros((len(full), len(prior))) + prior
                    for g in grams(x, heads):
                        for k in range(len(prior)):
                            total[:, k] += np.add.reduceat(matrix[k][g], heads[full], dtype=np.float64)
                    known = np.add.reduceat(x != 0, heads[full], dtype=np.int64) > 0
                    top = total.max(1)
                    best[full] = np.where(known, total.argmax(1), best[full])
                    score[full] = np.where(known, 1 / np.exp(total - top[:, None]).sum(1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c + 1).slice(i, n) for c in range(len(fields))),
                     pa.array(langs[best]), pa.array(score)],
                    names=[*(f.name for f in fields), "lang_pred", "score"])

    from pyspark.sql.types import DoubleType, StringType, StructField, StructType
    schema = StructType([*fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return docs.select("text", *carried).mapInArrow(run, schema)


def held_out(mod: int, fold: int) -> Column:
    """True for rows of the fold; a null doc_id is in no fold."""
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(mod)) == fold, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """Train on the rows outside the held-out fold, predict every row."""
    out = held_out(4, 2)
    model = train(docs.where(~out & F.col("doc_id").isNotNull()).select("text", "lang"))
    return predict(docs.select("text", "doc_id", out.alias("held_out")), model, "doc_id", "held_out")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose language is recognised; other columns, of any
    names, pass."""
    out = held_out(4, 2)
    model = train(docs.where(~out & F.col("doc_id").isNotNull()).select("text", "lang"))
    return beside(docs, lambda rows: predict(rows, model, *rows.columns).where(
        (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)))

"""Shared helpers: table access, written intermediates, vectorised words.

Everything that works on text bytes does so on slices of at most
``SLICE_BYTES`` (one longer text is a slice of its own), so memory in a task
follows the slice, not the Arrow batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollwise.session import fresh_path

SLICE_BYTES = 1 << 21
U64 = np.uint64
#: White space of the word pattern [^\x20\x09-\x0D]+, as bytes.
WS_BYTES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts lineage, and a
    lost executor costs nothing that was already written."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out


def removed(*frames: DataFrame) -> None:
    """Deletes written intermediates whose readers are all written."""
    for df in frames:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._saved_path)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


#: The columns of documents that operators read and pass on by name.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def beside(docs: DataFrame, stage: Callable[[DataFrame], DataFrame], core: tuple[str, ...] = DOCUMENT) -> DataFrame:
    """``stage(docs)`` while all columns but ``core`` bear other names, so none
    clashes with a column that the stage makes; returns the columns of ``docs``."""
    own = [c if c in core else f"_beside{i}" for i, c in enumerate(docs.columns)]
    out = stage(docs.select(*[docs[f"`{c}`"].alias(a) for c, a in zip(docs.columns, own)]))
    return out.select(*[F.col(a).alias(c) for c, a in zip(docs.columns, own)])


def text_or_empty(col: Column | str = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def words_col(text: Column) -> Column:
    """Words of ``text`` as a native array (empty for empty or null)."""
    text = F.coalesce(text, F.lit(""))
    for sign in WS_BYTES[1:].decode():
        text = F.replace(text, F.lit(sign), F.lit(" "))
    return F.array_remove(F.split(text, " "), "")


def bind(value: Column, body) -> Column:
    """body(value) with ``value`` computed once a row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: a bijection of 64-bit integers."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n pseudo-random 64-bit integers of a seed."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=U64) + U64(seed) * U64(1 << 20)) * U64(0x9E3779B97F4A7C15))


def utf8(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]] if len(off) else raw[:0], off - off[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows [i, j) of at most ``most`` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


_WORD = np.ones(256, dtype=bool)
_WORD[list(WS_BYTES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
BYTE_VALUE = stream(11, 256)


def word_hashes(raw: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word and the row it is in, in text order."""
    n = len(raw)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    inside = _WORD[raw]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    heads = off[:-1][off[:-1] < off[1:]]
    begin[heads] = inside[heads]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(inside)
    word = np.cumsum(begin[at]) - 1
    pos = at - starts[word]
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(int(pos.max()) + 1, 0xD6E8FEB86659FD93, dtype=U64))
        value = BYTE_VALUE[_LOWER[raw[at]] if lower else raw[at]] * power[pos]
        first = np.flatnonzero(begin[at])
        size = np.diff(np.append(first, len(at))).astype(U64)
        h = mix64(np.add.reduceat(value, first) + size * U64(0x9E3779B97F4A7C15))
    return h, np.searchsorted(off, starts, side="right") - 1

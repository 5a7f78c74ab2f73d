"""Product codes of vectors, the nearest entry found by a GNAT over a codebook.

Components become whole numbers, floor(SCALE * x), and a vector ``PARTS``
consecutive parts with a codebook each: at first the parts of the ``ENTRIES``
rows of least vec_id (equal ids by vector), then ``ROUNDS`` times the floored
means of what is assigned to an entry.  All arithmetic on distances, sums and
means is in integers.

Each round builds a GNAT (geometric near-neighbour access tree) over a
codebook.  A node has up to ``SPLITS`` split points, far from each other; each
other entry belongs to the nearest of them; for split i and child j the node
stores the least and greatest distance from i to j's subtree.  A query within
r of its best entry drops child j when its distance to i, give or take r, lies
strictly outside of that range.  Bounds are rounded outwards, so no entry that
could be as near is dropped; among entries the squared distances decide as
integers, ties by the lower index.  Queries walk the tree together, as arrays.

Per round a task sends one row per entry and component; the driver holds the
codebooks only (PARTS x ENTRIES vectors), never rows.

Rows are dropped whose vector is null or empty, holds null or non-finite
components, or is of another length than that of the least vec_id (null ids
last).  So are rows with a component beyond ``widest(length)``, above which
sums of squares would leave 64 bits (2^15 at 64 components).  A length that 8
does not divide is cut at floor(length * part / 8); a part without components
has code 00.  Fewer rows than ``ENTRIES`` give as many entries.  A null vec_id
is coded but starts no codebook; repeated rows each give a row.  Nothing to
code gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollwise.llm.common import saved

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
SPLITS = 4
#: Rows that walk a tree together.
BLOCK = 1 << 14
#: A distance is a rounded square root of a rounded integer: off by less than this share.
_OUT = 1 + 2.0 ** -50


def widest(length: int) -> float:
    """Components of this size or more are treated as non-finite."""
    bits = (63 - 2 - int(length - 1).bit_length()) // 2
    return float(2 ** bits) / SCALE


class Gnat:
    """Nearest entries of a codebook (k, d) of integers."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)))

    def _squares(self, x: np.ndarray, entry: int) -> np.ndarray:
        gap = x - self.entries[entry]
        return np.einsum("ij,ij->i", gap, gap)

    def _node(self, members: np.ndarray) -> dict:
        split = [int(members[0])]
        near = self._squares(self.entries[members], split[0])
        while len(split) < min(SPLITS, len(members)):
            rest = np.isin(members, split, invert=True)
            split.append(int(members[rest][near[rest].argmax()]))  # far from the splits so far
            near = np.minimum(near, self._squares(self.entries[members], split[-1]))
        rest = members[np.isin(members, split, invert=True)]
        to_split = np.stack([self._squares(self.entries[rest], s) for s in split])
        owner = to_split.argmin(0) if len(rest) else np.zeros(0, int)
        low, high = np.full((len(split),) * 2, np.inf), np.full((len(split),) * 2, -np.inf)
        children = []
        for j, s in enumerate(split):
            child = rest[owner == j]
            subtree = np.append(child, s)
            for i, p in enumerate(split):
                d = np.sqrt(self._squares(self.entries[subtree], p).astype(np.float64))
                low[i, j], high[i, j] = d.min() / _OUT, d.max() * _OUT
            children.append(self._node(child) if len(child) else None)
        return {"split": split, "low": low, "high": high, "children": children}

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each row's nearest entry; int64 rows."""
        best = np.full(len(x), len(self.entries), np.int64)
        square = np.full(len(x), np.iinfo(np.int64).max, np.int64)
        self._visit(self.root, x, np.arange(len(x)), best, square)
        return best, square

    def _visit(self, node: dict, x: np.ndarray, rows: np.ndarray, best: np.ndarray, square: np.ndarray) -> None:
        m = len(node["split"])
        alive = np.ones((m, len(rows)), bool)
        known = np.full((m, len(rows)), np.nan)

        def eliminate(i: int, at: np.ndarray) -> None:
            """Children that split i's distance puts out of reach of rows ``at``."""
            d, r = known[i, at], np.sqrt(square[rows[at]].astype(np.float64)) * _OUT
            for j in range(m):
                outside = (d / _OUT > (node["high"][i, j] + r) * _OUT) | ((d * _OUT + r) * _OUT < node["low"][i, j])
                alive[j, at[outside]] = False

        for i, s in enumerate(node["split"]):
            at = np.flatnonzero(alive[i])
            if not len(at):
                continue
            who = rows[at]
            found = self._squares(x[who], s)
            closer = (found < square[who]) | ((found == square[who]) & (s < best[who]))
            best[who[closer]], square[who[closer]] = s, found[closer]
            known[i, at] = np.sqrt(found.astype(np.float64))
            eliminate(i, at)
        for j, child in enumerate(node["children"]):
            if child is None:
                continue
            for i in range(m):  # the best entries may be nearer by now
                eliminate(i, np.flatnonzero(alive[j] & ~np.isnan(known[i])))
            left = rows[alive[j]]
            if len(left):
                self._visit(child, x, left, best, square)


def cuts(length: int, parts: int = PARTS) -> list[tuple[int, int]]:
    return [(length * p // parts, length * (p + 1) // parts) for p in range(parts)]


def _assigned(batch: pa.RecordBatch, column: str, trees: list[Gnat], ends: list[tuple[int, int]]):
    """Blocks of rows: where each starts, its vectors, entry indexes and squared errors by part."""
    length = ends[-1][1]
    flat = batch.column(column).flatten().to_numpy().reshape(-1, length)
    for start in range(0, len(flat), BLOCK):
        x = flat[start:start + BLOCK].astype(np.int64)
        pairs = [tree.nearest(x[:, a:b]) for tree, (a, b) in zip(trees, ends)]
        yield start, x, np.stack([p[0] for p in pairs]), np.stack([p[1] for p in pairs])


def _sums(books: list[np.ndarray], ends: list[tuple[int, int]]):
    """(part, entry, at, total, n): a task's sums of what each entry has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, k, length = [Gnat(b) for b in books], len(books[0]), ends[-1][1]
        total, n = np.zeros((k, length), np.int64), np.zeros((len(ends), k), np.int64)
        for batch in batches:
            for _, x, entry, _ in _assigned(batch, "v", trees, ends):
                for p, (a, b) in enumerate(ends):
                    n[p] += np.bincount(entry[p], minlength=k)
                    np.add.at(total[:, a:b], entry[p], x[:, a:b])
        rows = [(p, e, i, int(total[e, i]), int(n[p, e])) for p, (a, b) in enumerate(ends)
                for e in range(k) if n[p, e] for i in range(a, b)]
        names = ["part", "entry", "at", "total", "n"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names=names)

    return run


def _codes(books: list[np.ndarray], ends: list[tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [Gnat(b) for b in books]
        for batch in batches:
            for start, x, entry, square in _assigned(batch, "v", trees, ends):
                rows = batch.slice(start, len(x))
                hexed = entry.T.astype(np.uint8).tobytes().hex()
                wide = 2 * len(ends)
                yield pa.RecordBatch.from_arrays(
                    [rows.column("vec_id"), rows.column("label"),
                     pa.array([hexed[i * wide:(i + 1) * wide] for i in range(len(x))]), pa.array(square.sum(0))],
                    names=["vec_id", "label", "code", "error"])

    return run


def whole_numbers(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, label, v: whole numbers) of the rows with a usable vector, and the length."""
    v = F.col("embedding").cast("array<double>")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", v.alias("x")).where(
        F.coalesce((F.size("x") > 0) & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))),
                   F.lit(False)))
    first = fine.orderBy(F.col("vec_id").asc_nulls_last(), "x").select(F.size("x")).first()
    length = first[0] if first else 0
    small = F.forall("x", lambda c: F.abs(c) < widest(max(length, 1)))
    return fine.where((F.size("x") == length) & small).select(
        "vec_id", "label", F.transform("x", lambda c: F.floor(c * SCALE).cast("int")).alias("v")), length


def train(rows: DataFrame, length: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks by part, each (entries, components) of int64."""
    ends = cuts(length)
    seeds = rows.where("vec_id is not null").orderBy("vec_id", "v").limit(entries).select("v").collect()
    if not seeds:  # no row has an id: the least vectors start
        seeds = rows.orderBy("v").limit(entries).select("v").collect()
    start = np.array([r.v for r in seeds], np.int64)
    books = [start[:, a:b].copy() for a, b in ends]
    for _ in range(rounds):
        sums = (rows.select("v").mapInArrow(_sums(books, ends), "part long, entry long, at long, total long, n long")
                .groupBy("part", "entry", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n")))
        for r in sums.collect():  # entries x length rows
            books[r.part][r.entry, r.at - ends[r.part][0]] = r.total // r.n
    return books


def digest(books: list[np.ndarray]) -> str:
    text = ",".join(str(c) for b in books for c in b.ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def encode(vectors: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Rows (vec_id, label, code, error, label_error, codebooks_sha256) of
    ``vectors`` (vec_id, embedding, label)."""
    rows, length = whole_numbers(vectors)
    label = vectors.schema["label"].dataType.simpleString()
    schema = f"vec_id long, label {label}, code string, error long"
    if not length:
        return vectors.sparkSession.createDataFrame([], f"{schema}, label_error long, codebooks_sha256 string")
    rows = saved(rows, "vectors")
    books = train(rows, length, entries, rounds)
    coded = saved(rows.mapInArrow(_codes(books, cuts(length)), schema), "codes")
    by_label = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    return (coded.join(by_label, _same("label", "_label")).drop("_label")
            .withColumn("codebooks_sha256", F.lit(digest(books))))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))

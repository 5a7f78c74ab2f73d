"""Mixing sources to target weights by iterative proportional fitting.

Token totals are gathered by (source, language, topic), each by its exact
value; the totals are raked until the marginals of all three meet their
targets; a document is kept with its cell's calibrated probability, drawn from
the hash of its id and text.

A target is a share for named values (None names null); for a marginal without
one it is the observed share to the power ``POWERS``, made to sum to 1.  Shares
of values without tokens go to the others.  The probabilities are raked under
the bound 1, so the tokens expected to be kept have the raked marginals; they
are ``KEEP`` of all, or the largest share at which the marginals can be met.

Up to ``MAX_CELLS`` cells of ``MAX_CHARS`` characters are raked on the driver,
more by the same rounds as Spark aggregates and joins.

Null source, language and text are values of their own (a null or empty text
has 0 tokens and probability 1).  Repeated rows share their fate.  An empty
table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollwise.llm.common import beside, saved

MAX_CELLS, MAX_CHARS = 100_000, 1 << 25
POWERS = {"source": 0.7, "lang": 0.7, "topic": 1.0}
KEEP = 0.9
#: Topics by the shape of a text, the first that holds.
TOPICS = ("empty", "table", "symbols", "capitals", "figures", "prose")


def tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"))


def topic(text: Column) -> Column:
    """Number of the topic in ``TOPICS``."""
    n = tokens(text)
    size = F.length(text)
    share = lambda pattern, of: F.regexp_count(text, F.lit(pattern)) >= of
    return (F.when(F.coalesce(n, F.lit(0)) == 0, 0).when(share(r"\|", n / 4), 1).when(share(r"[#*$%&<>]", size / 10), 2)
            .when(share(r"\p{Lu}", size / 3), 3).when(share(r"[0-9]", size / 4), 4).otherwise(5))


def exact(name: str) -> Column:
    """The value as a key to join by; null is apart from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit(""))


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with _s, _l, _t (cell), _n (tokens) and _u (0 to 1, drawn by hash)."""
    draw = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 40) - 1)) / F.lit(float(1 << 40))
    return docs.withColumns({"_s": exact("source"), "_l": exact("lang"), "_t": topic(F.col("text")),
                             "_n": tokens(F.col("text")).cast("long"), "_u": draw})


class Local:
    """Cells on the driver: tokens, and the place of each in its marginals.  A
    ratio is an array like the tokens."""

    def __init__(self, total: np.ndarray, keys: list[np.ndarray], sizes: list[int]):
        self.total, self.keys, self.sizes = total.astype(float), keys, sizes
        self.whole, self.ones = float(total.sum()), np.ones(total.shape)

    def marginals(self, x: np.ndarray) -> list[np.ndarray]:
        return [self._marginal(x, axis) for axis in range(len(self.keys))]

    def _marginal(self, x: np.ndarray, axis: int) -> np.ndarray:
        return np.bincount(self.keys[axis].ravel(), (x * self.total).ravel(), self.sizes[axis])

    def step(self, x: np.ndarray, goals: list[np.ndarray], scale: float, most: float) -> tuple[np.ndarray, float]:
        """``x`` scaled along each axis in turn, and how far it was off."""
        off = 0.0
        for axis, goal in enumerate(goals):
            now = self._marginal(np.minimum(x, most), axis)
            off = max(off, float(np.abs(now - goal * scale).max()))
            x = x * np.divide(goal * scale, now, out=np.zeros_like(now), where=now > 0)[self.keys[axis]]
        return x, off / max(self.whole * scale, 1e-300)

    def top(self, x: np.ndarray) -> float:
        return float(x[self.total > 0].max())

    def room(self, goals: list[np.ndarray]) -> float:
        """The largest scale at which no goal is over its tokens."""
        return min(float((have[goal > 0] / goal[goal > 0]).min()) for have, goal in zip(self.marginals(self.ones), goals))

    def times(self, x: np.ndarray, k: float) -> np.ndarray:
        return x * k


class Spread:
    """Cells as rows _s, _l, _t, n; a ratio is such rows with x."""

    AXES = ("_s", "_l", "_t")

    def __init__(self, rows: DataFrame, whole: float):
        self.whole, self.ones = whole, rows.withColumn("x", F.lit(1.0))

    def marginals(self, x: DataFrame) -> list[DataFrame]:
        return [saved(x.groupBy(name).agg(F.sum(F.col("x") * F.col("n")).alias("goal")), "goals") for name in self.AXES]

    def step(self, x: DataFrame, goals: list[DataFrame], scale: float, most: float) -> tuple[DataFrame, float]:
        off = 0.0
        for name, goal in zip(self.AXES, goals):
            now = x.groupBy(name).agg(F.sum(F.least("x", F.lit(most)) * F.col("n")).alias("now"))
            steps = saved(now.join(goal, name).select(
                name, F.when(F.col("now") > 0, F.col("goal") * scale / F.col("now")).otherwise(0.0).alias("f"),
                F.abs(F.col("now") - F.col("goal") * scale).alias("off")), "steps")
            off = max(off, steps.agg(F.max("off")).first()[0])
            x = x.join(steps.drop("off"), name).withColumn("x", F.col("x") * F.col("f")).select("_s", "_l", "_t", "n", "x")
        return saved(x, "ratios"), off / (self.whole * scale)

    def top(self, x: DataFrame) -> float:
        return x.agg(F.max("x")).first()[0]

    def room(self, goals: list[DataFrame]) -> float:
        return min(have.withColumnRenamed("goal", "have").join(goal, name).where("goal > 0").agg(F.min(F.col("have") / F.col("goal"))).first()[0]
                   for name, have, goal in zip(self.AXES, self.marginals(self.ones), goals))

    def times(self, x: DataFrame, k: float) -> DataFrame:
        return x.withColumn("x", F.col("x") * k)


def fit(cells, x, goals: list, scale: float = 1.0, most: float = float("inf"), rounds: int = 1000, error: float = 1e-9) -> tuple:
    """``x`` stepped until min(x, most) meets the scaled goals, and how far it
    is off; given up where 25 rounds don't halve that."""
    last = float("inf")
    for k in range(rounds):
        x, off = cells.step(x, goals, scale, most)
        if off < error:
            break
        if k % 25 == 24:
            if off > last / 2:
                break
            last = off
    return x, off


def bounded(cells, x, keep: float) -> tuple:
    """(ratios to cut at 1, scale): the ratios ``x`` raked under the bound 1 to
    ``keep`` of their marginals, or to the most of them that can be met."""
    goals = cells.marginals(x)
    low = min(keep, 1 / cells.top(x))  # no cell is over the bound
    best, high = cells.times(x, low), min(keep, cells.room(goals))
    if low >= high:
        return best, low
    k = high
    for _ in range(12):
        y, off = fit(cells, cells.times(x, k), goals, k, 1.0, error=1e-7)
        if off < 1e-7:
            best, low = y, k
        else:
            high = k
        if high - low < 1e-4:
            break
        k = (low + high) / 2
    return best, low


def _dense(total: np.ndarray) -> Local:
    return Local(total, list(np.indices(total.shape)), list(total.shape))


def rake(total: np.ndarray, targets: list[np.ndarray]) -> np.ndarray:
    """``total`` scaled along each axis in turn until its marginals are the targets'."""
    cells = _dense(total)
    goals = []
    for have, goal in zip(cells.marginals(cells.ones), targets):
        goal = np.where(have > 0, goal, 0.0)
        goals.append(goal / goal.sum() * cells.whole if goal.sum() else (have > 0) / max(1, (have > 0).sum()) * cells.whole)
    return fit(cells, cells.ones, goals)[0] * total


def probabilities(total: np.ndarray, fitted: np.ndarray, keep: float = KEEP) -> np.ndarray:
    """Probabilities that keep ``keep`` of all tokens, with the marginals of
    ``fitted`` where that share allows them; see ``bounded`` for the share that does."""
    cells = _dense(total)
    ratio = np.divide(fitted, total, out=np.zeros_like(fitted), where=total > 0)
    ratio = fit(cells, ratio * keep, cells.marginals(ratio), keep, 1.0)[0]
    kept = lambda r: float((np.minimum(1, r * ratio) * total).sum())
    goal = min(keep * total.sum(), float(total[ratio > 0].sum()))
    lo, hi = 0.0, 1.0
    while kept(hi) < goal * (1 - 1e-12) and hi < 1e12:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if kept(mid) < goal else (lo, mid)
    return np.where(total > 0, np.minimum(1, hi * ratio), 1.0)


def goals_of(total: DataFrame, whole: float, weights: dict[str, dict[str | None, float]] | None) -> list[DataFrame]:
    """Of each marginal the tokens (value, goal) it should have, ``whole`` in sum."""
    out = []
    for axis, (name, power) in zip(Spread.AXES, POWERS.items()):
        rows = total.groupBy(axis).agg(F.sum("n").alias("n"))
        goal = F.pow(F.col("n") / whole, F.lit(power))
        if weights and name in weights:
            key = TOPICS.index if name == "topic" else lambda v: "" if v is None else "=" + v
            data = [(key(v), float(w)) for v, w in weights[name].items()]
            given = total.sparkSession.createDataFrame(data, f"{axis} {'int' if name == 'topic' else 'string'}, w double")
            rows, goal = rows.join(given, axis, "left"), F.coalesce("w", F.lit(0.0))
        rows = saved(rows.select(axis, goal.alias("goal")), "targets")
        share = rows.agg(F.sum("goal"), F.count("*")).first()
        out.append(rows.withColumn("goal", F.col("goal") / share[0] * whole if share[0] else F.lit(whole / max(share[1], 1))))
    return out


def cells(rows: DataFrame, weights: dict[str, dict[str | None, float]] | None = None, keep: float = KEEP) -> tuple[DataFrame, bool]:
    """(_s, _l, _t, probability, weight) of each cell of ``placed`` rows that
    has tokens, and whether they are few enough to broadcast."""
    spark = rows.sparkSession
    total = saved(rows.where("_n > 0").groupBy("_s", "_l", "_t").agg(F.sum("_n").alias("n")), "cells")
    n, chars, whole = total.agg(F.count("*"), F.sum(F.length("_s") + F.length("_l")), F.sum("n")).first()
    if not n:
        return spark.createDataFrame([], "_s string, _l string, _t int, probability double, weight double"), True
    goals = goals_of(total, float(whole), weights)
    if n > MAX_CELLS or chars > MAX_CHARS:
        spread = Spread(total, float(whole))
        ratio = fit(spread, spread.ones, goals)[0]
        p = bounded(spread, ratio, keep)[0].select("_s", "_l", "_t", F.least("x", F.lit(1.0)).alias("probability"))
        return ratio.select("_s", "_l", "_t", F.col("x").alias("weight")).join(p, ["_s", "_l", "_t"]), False
    found = total.toArrow()
    coded = [found[axis].combine_chunks().dictionary_encode() for axis in Spread.AXES]
    local = Local(found["n"].to_numpy(), [c.indices.to_numpy() for c in coded], [len(c.dictionary) for c in coded])
    wanted = [dict(g.collect()) for g in goals]  # no more than cells
    ratio = fit(local, local.ones, [np.array([w[v] for v in c.dictionary.to_pylist()]) for c, w in zip(coded, wanted)])[0]
    p = np.minimum(1, bounded(local, ratio, keep)[0])
    return spark.createDataFrame(pa.table({**{a: found[a] for a in Spread.AXES}, "probability": p, "weight": ratio})), True


def _judged(rows: DataFrame, of_cell: DataFrame, few: bool) -> DataFrame:
    # Broadcast: MAX_CELLS rows and MAX_CHARS characters at most.
    return rows.join(F.broadcast(of_cell) if few else of_cell, ["_s", "_l", "_t"], "left").withColumn(
        "probability", F.coalesce("probability", F.lit(1.0)))


def mix(docs: DataFrame, weights: dict[str, dict[str | None, float]] | None = None, keep: float = KEEP) -> DataFrame:
    """A row per document: its cell, tokens, weight, probability and verdict."""
    rows = saved(placed(docs.select("doc_id", "text", "source", "lang")).drop("text"), "mixing")
    names = F.array(*map(F.lit, TOPICS))
    return _judged(rows, *cells(rows, weights, keep)).select(
        "doc_id", "source", "lang", F.get(names, F.col("_t")).alias("topic"), F.col("_n").alias("n_tokens"),
        F.coalesce("weight", F.lit(1.0)).alias("weight"), "probability", (F.col("_u") < F.col("probability")).alias("kept"))


def sampled(docs: DataFrame, weights: dict[str, dict[str | None, float]] | None = None, keep: float = KEEP) -> DataFrame:
    """The documents kept, with their own columns, of any names."""

    def drawn(docs: DataFrame) -> DataFrame:
        rows = placed(docs)
        return _judged(rows, *cells(rows, weights, keep)).where(F.col("_u") < F.col("probability"))

    return beside(docs, drawn)

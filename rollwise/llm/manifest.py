"""Merkle manifest of a dataset, membership proofs by pointer jumping.

A leaf is H of doc_id, source, lang, n_chars and text; H is SHA-256 in lower-case
hex over the concatenated inputs, a digest going in as its hex text, a field as
``-`` for null or else its UTF-8 byte count, ``:`` and value.  Per source leaves
ascend by doc_id; ``ARITY`` neighbours become their H until one node, the
subroot, is left.  Subroots in order of source give the root in the same way.

*Positions* are found without ordering any group in one task: rows are dealt by
ranges of (source, doc_id, leaf), counted by range and source, and numbered
within their range; a range holds a bounded part of a hot source.

*Nodes* hold a pointer to an ancestor and the segment of sibling digests on the
way to it, at first the parent.  Each round joins the nodes with themselves on
the pointer: distances double, segments are concatenated.  Nodes that nobody
points to any more leave, so after round k of a source's tree every 2^k-th
level is left.  Leaves are joined with every round's nodes, all in one job, and
reach the root after log2(height) joins.  A join's right side has one row per
key and its left side may be split by AQE, so a hot ancestor needs no task of
its own.

Defined cases: a null doc_id comes first and is never tampered with; equal
doc_ids of a source are ordered by leaf, equal rows are leaves of their own;
null source is a source before all others, '' another; a lone leaf is a
subroot, a lone subroot the root; an empty table gives no rows.  Other columns
of the input are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollwise.llm.common import removed, saved

ARITY = 3
#: Levels that one shuffle of the building adds: ARITY ** LEVELS nodes meet in a row.
LEVELS = 4
#: Keys of nodes: level << PLACES | global number of the first leaf below; the
#: tree of subroots has levels from TOP on, numbered by source.
PLACES = 56
TOP = 64
PATH = "array<struct<l:binary,r:binary>>"


def field(c: str | Column) -> Column:
    """``-`` for null, else byte count, ``:``, value."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def digest(*inputs: Column) -> Column:
    """SHA-256 of the concatenated inputs, as bytes."""
    return F.unhex(F.sha2(F.concat(*inputs), 256))


def hexed(c: str | Column) -> Column:
    return F.lower(F.hex(c))


def leaf_of(text: Column) -> Column:
    return digest(field("doc_id"), field("source"), field("lang"), field("n_chars"), field(text))


def _key(level: Column, at: Column) -> Column:
    return F.shiftleft(level.cast("long"), PLACES) + at


def _numbered(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``tree`` (0, 1, ... by ``group``, null first), ``idx``
    (position within it by ``order``), ``first`` (rows of smaller groups) and
    ``n`` (rows of the group); and the groups (group, tree, first, n)."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    # Written, so a lost executor never deals the rows anew by another sample.
    dealt = saved(rows.repartitionByRange(parts, group, *order).withColumn("range", F.spark_partition_id()), "dealt")
    sizes = saved(dealt.groupBy("range", group).agg(F.count("*").alias("m")), "sizes")
    # A group's ranges, and the ranges, are as many as partitions at most.
    groups = sizes.groupBy(group).agg(F.min("range").alias("starts"), F.sum("m").alias("n"))
    begun = groups.groupBy("starts").agg(F.count("*").alias("trees"), F.sum("n").alias("rows"))
    before = Window.orderBy("starts").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("starts", F.coalesce(F.sum("trees").over(before), F.lit(0)).alias("trees_before"),
                         F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    here = Window.partitionBy("starts").orderBy(F.col(group).asc_nulls_first())
    groups = saved(groups.join(begun, "starts").select(
        group, (F.row_number().over(here) - 1 + F.col("trees_before")).alias("tree"),
        (F.coalesce(F.sum("n").over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("rows_before")).alias("first"),
        "n"), "groups")
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (sizes.select("range", group, F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("skip"))
               .join(groups.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g")))
               .select(F.col("range").alias("_range"), "_g", "skip", "tree", "first", "n"))
    within = Window.partitionBy("range", group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    placed = (dealt.withColumn("_k", F.row_number().over(within) - 1)
              .join(offsets, (F.col("range") == F.col("_range")) & F.col(group).eqNullSafe(F.col("_g")))
              .withColumn("idx", F.col("_k") + F.col("skip")).drop("_k", "_range", "_g", "skip", "range"))
    placed = saved(placed, "placed")
    removed(dealt, sizes)
    return placed, groups


def _height(n: Column) -> Column:
    """Levels above n leaves, by whole numbers."""
    return F.aggregate(F.sequence(F.lit(1), F.lit(40)), F.struct(n.cast("long").alias("n"), F.lit(0).alias("h")),
                       lambda acc, _: F.when(acc["n"] > 1, F.struct(F.floor((acc["n"] + (ARITY - 1)) / ARITY).alias("n"),
                                                                    (acc["h"] + 1).alias("h"))).otherwise(acc))["h"]


def _parents(nodes: Column) -> Column:
    """The level above an array of digests."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: digest(F.array_join(F.transform(F.slice(nodes, i * ARITY + 1, ARITY), hexed), "")))


def _built(leaves: DataFrame, lowest: int, highest: int) -> tuple[list[DataFrame], DataFrame]:
    """The trees over ``leaves`` (tree, idx, hash, n, start, end): nodes (key,
    ptr, path) of all levels below their top, and the tops (tree, hash).
    ``start``: global number of the tree's first leaf; ``end``: the key that
    its top node goes by; levels are numbered from ``lowest``."""
    level, nodes, tops = 0, [], []
    while True:
        height = _height(F.col("n")) - level
        done = leaves.where(height <= 0).select("tree", "hash", "idx", "start", "end")
        if level == 0:  # a lone leaf: its way to the tree's end is empty
            nodes.append(done.select(_key(F.lit(lowest), F.col("start")).alias("key"), F.col("end").alias("ptr"),
                                     F.array().cast(PATH).alias("path")))
        tops.append(done.select("tree", "hash"))
        if level >= highest:
            return nodes, _union(tops)
        block = F.floor(F.col("idx") / ARITY ** LEVELS)
        met = (leaves.where(height > 0).groupBy("tree", block.alias("block"))
               .agg(F.sort_array(F.collect_list(F.struct("idx", "hash"))).alias("met"),  # ARITY ** LEVELS at most
                    F.first("n").alias("n"), F.first("start").alias("start"), F.first("end").alias("end")))
        steps = F.least(_height(F.col("n")) - level, F.lit(LEVELS))
        tower = F.aggregate(F.sequence(F.lit(1), steps), F.array(F.col("met.hash")),
                            lambda acc, _: F.concat(acc, F.array(_parents(F.element_at(acc, -1)))))
        met = saved(met.select("tree", "block", "n", "start", "end", steps.alias("steps"), tower.alias("tower")), "tower")
        each = (met.select("*", F.posexplode("tower").alias("up", "row")).where(F.col("up") < F.col("steps"))
                .select("tree", "block", "start", "end", "n", "up", "row", F.posexplode("row").alias("i", "hash")))
        run = F.floor(F.col("i") / ARITY).cast("int") * ARITY
        side = lambda a, b: F.unhex(F.array_join(F.transform(F.slice("row", a + 1, b - a), F.hex), ""))
        path = F.array(F.struct(side(run, F.col("i")).alias("l"), side(F.col("i") + 1, run + ARITY).alias("r")))
        width = F.pow(F.lit(ARITY), F.col("up")).cast("long")  # of a node, in nodes of this round's lowest level
        unit = F.lit(ARITY ** level).cast("long")
        first = F.col("start") + (F.col("block") * ARITY ** LEVELS + F.col("i") * width) * unit
        above = F.col("start") + (F.col("block") * ARITY ** LEVELS + F.floor(F.col("i") / ARITY) * ARITY * width) * unit
        at = F.col("up") + level + 1
        nodes.append(each.select(_key(F.col("up") + (lowest + level), first).alias("key"),
                                 F.when(at == _height(F.col("n")), F.col("end")).otherwise(_key(at + lowest, above)).alias("ptr"),
                                 path.alias("path")))
        last = F.element_at("tower", -1)
        leaves = saved(met.select("tree", F.col("block").alias("idx"), F.element_at(last, 1).alias("hash"), "n", "start", "end"),
                       "level")
        level += LEVELS


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _jump(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left`` with its pointers moved on by ``right``'s; those at the root stay."""
    r = right.select(F.col("key").alias("_key"), F.col("ptr").alias("_ptr"), F.col("path").alias("_path"))
    return (left.join(r, F.col("ptr") == F.col("_key"), "left")
            .withColumn("path", F.concat("path", F.coalesce("_path", F.array().cast(PATH))))
            .withColumn("ptr", F.coalesce("_ptr", "ptr")).drop("_key", "_ptr", "_path"))


def _level(key: str) -> Column:
    return F.shiftright(key, PLACES)


def manifest(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, leaf, leaf_now, subroot, root, path) of ``docs``;
    digests are bytes, ``leaf_now`` is the leaf of the text after tampering,
    ``path`` the siblings (l: to the left, r: to the right) of each level."""
    spark = docs.sparkSession
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    changed = F.when(tampered & F.contains("text", F.lit("\n")), leaf_of(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    leaves = saved(docs.select("doc_id", "source", leaf_of(F.col("text")).alias("hash"), changed.alias("changed")), "leaves")
    placed, sources = _numbered(leaves, "source", ["doc_id", "hash"])
    removed(leaves)
    widest = sources.agg(F.max(_height(F.col("n"))).alias("h"), F.count("*").alias("n")).select(
        "h", "n", _height(F.col("n")).alias("top")).first()
    if not widest.n:
        return _nothing(spark)

    low, subroots = _built(placed.select("tree", "idx", "hash", "n", F.col("first").alias("start"),
                                       _key(F.lit(TOP), F.col("tree")).alias("end")), 0, widest.h)
    subroots = saved(subroots, "subroots")
    end = F.lit((TOP + widest.top) << PLACES)
    high, top = _built(subroots.select(F.lit(0).alias("tree"), F.col("tree").alias("idx"), "hash", F.lit(widest.n).alias("n"),
                                       F.lit(0).cast("long").alias("start"), end.alias("end")), TOP, widest.top)
    root = top.first().hash

    every = _union(low + high)
    own = every.where(_level("key") == 0)
    nodes = saved(every.where(_level("key") > 0), "nodes")
    out = (placed.select("doc_id", "source", F.col("hash").alias("leaf"), F.coalesce("changed", "hash").alias("leaf_now"), "tree",
                         _key(F.lit(0), F.col("first") + F.col("idx")).alias("_leaf"))
           .join(own.withColumnRenamed("key", "_own"), F.col("_leaf") == F.col("_own")).drop("_leaf", "_own"))
    reach = 1
    while reach < widest.h + widest.top + 1:  # a lone leaf's way to the top tree counts as one
        out = _jump(out, nodes)
        reach *= 2
        kept = nodes.where((_level("key") >= TOP) | (_level("key") % reach == 0))
        nodes = saved(_jump(kept, nodes), "nodes")
    out = out.join(subroots.select(F.col("tree").alias("_tree"), F.col("hash").alias("subroot")), F.col("tree") == F.col("_tree"))
    return out.select("doc_id", "source", "leaf", "leaf_now", "subroot", F.lit(root).alias("root"), "path")


def _nothing(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], f"doc_id long, source string, leaf binary, leaf_now binary, subroot binary, root binary, path {PATH}")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, hexed(leaf), lambda acc, s: F.sha2(F.concat(hexed(s["l"]), acc, hexed(s["r"])), 256))


def verify(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (doc_id, source, lang, n_chars, text): doc_id,
    leaf, subroot, root, proof_sha256, folded_root (of the tampered leaf where
    there is one), verified; source."""
    m = manifest(docs)
    proof = F.array_join(F.transform("path", lambda s: F.concat(hexed(s["l"]), hexed(s["r"]))), "")
    found = m.withColumn("folded_root", folded(F.col("leaf_now"), F.col("path")))
    return found.select("doc_id", "source", hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"),
                        hexed("root").alias("root"), F.sha2(proof, 256).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == hexed("root")).alias("verified"))

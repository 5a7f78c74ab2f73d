"""MinHash near-duplicates by a signature-coordinate inverted join.

Every text becomes a set of word shingles, the set a signature of ``COORDS``
minima.  A text is posted under its (coordinate, value) tokens; two texts
that share ``MATCHES`` tokens or more are compared on their full sets.

* *Core*: a text with fewer than ``MATCHES`` tokens that any other text has
  can have no partner and leaves.
* *Prefix*: with a text's k remaining shared tokens in one global order (rare
  first), two texts with ``MATCHES`` in common share one of their first
  ``k - MATCHES + 1``, so only these are posted.
* *Skip*: the other, longest lists are never merged; the rest of a
  collision count is read from the two signatures.

The chance to miss a pair is that of fewer than ``MATCHES`` hits in
``COORDS`` draws at its similarity: below 1e-5 at 0.8.

Groups of copies of any size stay linear: equal sets are one node; in each
list a leader is compared with the others and then leaves it, first the
least node, then the one with most links.  Lists whose nodes are in one
component by then are done.  A node leaves the other lists of more than
``LONG`` nodes if too few of its shingles are those of another component in
such lists, as documents do that have but a passage in common; the pairs
across components that are left are compared, in blocks of ``BLOCK`` nodes.
No step emits the pairs of a group.

A node is the 64-bit hash of a shingle set.  Null and empty texts have an
empty set and link with nothing; a text of fewer words than the shingle is
one shingle.  Repeated rows of one doc_id each give a row.  A null doc_id
is kept out of the choice of a component's least doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rollwise.llm.common import U64, beside, mix64, removed, saved, slices, stream, utf8, word_hashes

COORDS = 32
MATCHES = 14
BLOCK = 4096
#: Lists of more nodes are thinned by full sets before they are compared.
LONG = 256
#: Bits of the map of documents whose sets are read again.
FILTER_BITS = 1 << 23


def shingles(raw: np.ndarray, off: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes sorted by (row, hash), and where each row starts."""
    rows = len(off) - 1
    words, row = word_hashes(raw, off)
    count = np.bincount(row, minlength=rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    with np.errstate(over="ignore"):
        # A window is one word longer-reaching at a time; rows with fewer words end early.
        h = np.full(len(words), 0x2545F4914F6CDD1D, dtype=U64)
        left = (first + count)[row] - np.arange(len(words)) if len(words) else np.zeros(0, np.int64)
        for k in range(width):
            nxt = np.zeros(len(words), U64)
            nxt[:len(words) - k] = words[k:]
            h = np.where(left > k, mix64(h * U64(0x9E3779B97F4A7C15) + nxt), h)
    short = count < width
    starts = left >= width
    starts[first[short & (count > 0)]] = True
    h, row = h[starts], row[starts]
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(row, minlength=rows))])


def _node(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One 64-bit key for each row's set."""
    with np.errstate(over="ignore"):
        total = np.concatenate([[U64(0)], np.cumsum(mix64(h))])
        again = np.concatenate([[U64(0)], np.cumsum(mix64(h ^ U64(0x5851F42D4C957F2D)))])
        return mix64((total[at[1:]] - total[at[:-1]])
                     + U64(0x9E3779B97F4A7C15) * mix64(again[at[1:]] - again[at[:-1]]) + np.diff(at).astype(U64))


def _signatures(width: int):
    add = stream(3, COORDS)
    mul = stream(5, COORDS) | U64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, off = utf8(batch.column(1))
            for i, j in slices(off):
                h, at = shingles(raw[off[i]:off[j]], off[i:j + 1] - off[i], width)
                size = np.diff(at)
                full = np.flatnonzero(size > 0)
                tokens = np.zeros((len(full), COORDS), U64)
                with np.errstate(over="ignore"):
                    for c in range(COORDS if len(full) else 0):
                        x = (h ^ add[c]) * mul[c]
                        low = np.minimum.reduceat(x ^ (x >> U64(29)), at[full])
                        tokens[:, c] = mix64(low + U64(c) * U64(0xD1342543DE82EF95))
                node = _node(h, at).view(np.int64)
                offsets = np.zeros(j - i + 1, np.int32)
                offsets[1:] = np.cumsum(np.where(size > 0, COORDS, 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(size, pa.int64()),
                     pa.array(node, pa.int64(), mask=size == 0),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens.ravel().view(np.int64)))],
                    names=["doc_id", "text_key", "n", "node", "tokens"])

    return run


def _sets(width: int, bits: bytes | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(bits, np.uint8)
        for batch in batches:
            at = batch.column(0).fill_null(-1).to_numpy(zero_copy_only=False) % FILTER_BITS
            batch = batch.filter(pa.array((seen[at >> 3] >> (at & 7)) & 1 == 1))
            raw, off = utf8(batch.column(1))
            for i, j in slices(off):
                h, at = shingles(raw[off[i]:off[j]], off[i:j + 1] - off[i], width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_node(h, at).view(np.int64)),
                     pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h.view(np.int64)))],
                    names=["node", "members"])

    return run


def _core(rows: DataFrame) -> DataFrame:
    """Of rows (node, token) the nodes with ``MATCHES`` tokens or more that
    another node has, too, and these tokens, rare first."""
    held = _held(rows, F.count("*").alias("m"))
    core = saved(rows.join(held, "token").groupBy("node")
                 .agg(F.sort_array(F.collect_list(F.struct("m", "token"))).alias("shared"))  # COORDS at most
                 .where(F.size("shared") >= MATCHES).select("node", F.col("shared.token").alias("shared")), "core")
    removed(held)
    return core


def _held(rows: DataFrame, *of_token) -> DataFrame:
    """Written aggregates of each token that more than one row has.  Written,
    so that a join with them can split the rows of a hot token."""
    return saved(rows.groupBy("token").agg(*of_token).where("m > 1"), "held")


def _similar(a: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) with members: those whose full sets are similar enough."""
    common = F.size(F.array_intersect("am", "bm"))
    return a.withColumn("common", common).where(
        100 * F.col("common") >= percent * (F.size("am") + F.size("bm") - F.col("common"))).select("a", "b")


def _full_sets(texts: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(node, members) of ``wanted`` (node, doc_id), one row a node.  Documents
    that share a bit of the map with one wanted give sets that no join asks for."""
    place = F.pmod(F.coalesce("doc_id", F.lit(-1)), F.lit(FILTER_BITS)) + 1
    maps = (wanted.groupBy(F.bitmap_bucket_number(place).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
            .collect())  # FILTER_BITS / 32,768 rows of 4 kB at most
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for bucket, part in maps:
        bits[(bucket - 1) * len(part):bucket * len(part)] = np.frombuffer(part, np.uint8)
    return saved(texts.mapInArrow(_sets(width, bits.tobytes()), "node long, members array<long>")
                 .dropDuplicates(["node"]), "sets")


def _confirmed(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Written links among candidate pairs: first sizes and the collision count of the
    whole signatures (the lists that were skipped), then the full sets."""
    known = nodes.select("node", "n", "tokens")
    hits = F.size(F.filter(F.zip_with("at", "bt", lambda x, y: x == y), lambda z: z))
    near = saved(pairs.join(known.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("tokens").alias("at")), "a")
                 .join(known.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("tokens").alias("bt")), "b")
                 .where(100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")).where(hits >= MATCHES)
                 .select("a", "b"), "near")
    ends = near.select(F.col("a").alias("node")).union(near.select(F.col("b").alias("node"))).distinct()
    sets = _full_sets(texts, nodes.select("node", "doc_id").join(ends, "node", "left_semi"), width)
    links = saved(_similar(near.join(sets.select(F.col("node").alias("a"), F.col("members").alias("am")), "a")
                           .join(sets.select(F.col("node").alias("b"), F.col("members").alias("bm")), "b"), percent), "links")
    removed(near, sets)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): least node reachable.

    Each round a node takes the least label next to it, then its label's
    label; labels are written each round, so a round never repeats another.
    """
    both = saved(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
                 "edges")
    labels = last = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), "labels")
    while True:
        step = (both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("r")), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
                .join(labels, "node").select("node", F.least("r", "root").alias("r"), F.col("root").alias("old")))
        up = labels.select(F.col("node").alias("r"), F.col("root").alias("up"))
        new = saved(step.join(up, "r", "left").select("node", F.least("r", F.coalesce("up", "r")).alias("root"), "old"), "labels")
        moved = not new.where(F.col("root") != F.col("old")).isEmpty()
        removed(last)
        labels, last = new.select("node", "root"), new
        if not moved:
            removed(both)
            return labels


def _merge(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """Roots after further links; only the graph between roots is walked."""
    if roots is None:
        return components(links)
    r = roots.select(F.col("node").alias("x"), "root")
    between = (links.join(r.select(F.col("x").alias("a"), F.col("root").alias("ra")), "a", "left")
               .join(r.select(F.col("x").alias("b"), F.col("root").alias("rb")), "b", "left")
               .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).where("a <> b"))
    top = components(between).select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = roots.join(top, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    fresh = top.select(F.col("root").alias("node"), F.col("top").alias("root"))
    return saved(old.unionByName(fresh.join(roots.select("node"), "node", "left_anti")), "roots")


def _open_lists(rows: DataFrame, *of_token) -> DataFrame:
    """Written lists (token, node, root, m, ...) of rows (token, node, root, ...): those with
    nodes of more than one component; the rest needs no look."""
    many = saved(rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("m"), *of_token)
                 .where("lo <> hi").drop("lo", "hi"), "many")
    lists = saved(rows.select("token", "node", "root").join(many, "token"), "lists")
    removed(many)
    return lists


def _next_lists(led: DataFrame, roots: DataFrame, links: DataFrame) -> DataFrame:
    """Open lists after links were found: the leaders leave, the node with most links is next."""
    degree = (links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node")))
              .groupBy("node").agg(F.count("*").alias("degree")))
    now = saved(led.where("node <> leader").select("token", "node").join(roots, "node", "left").join(degree, "node", "left")
                .select("token", "node", F.coalesce("root", "node").alias("root"), F.coalesce("degree", F.lit(0)).alias("degree")),
                "now")
    lists = _open_lists(now, F.max(F.struct("degree", "node")).getField("node").alias("leader"))
    removed(now, led)
    return lists


def _thinned(lists: DataFrame, held: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """``lists``, written, without the places in long lists of nodes that have no partner there.

    Of a node's set of n, a partner has percent * n / 100 members or more; so
    many must be held by other components in long lists.
    """
    long = lists.where(F.col("m") > LONG)
    if long.isEmpty():
        return lists
    places = saved(long.select("node", "root").distinct(), "places")
    sets = _full_sets(texts, held.join(places, "node", "left_semi"), width)
    posts = places.join(sets, "node").select("node", "root", F.size("members").alias("n"), F.explode("members").alias("member"))
    shared = saved(posts.groupBy("member").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                   .where("lo <> hi").select("member"), "shared")
    able = saved(posts.select("node", "n", "member").join(shared, "member").groupBy("node")
                 .agg(F.first("n").alias("n"), F.count("*").alias("k")).where(100 * F.col("k") >= percent * F.col("n")), "able")
    kept = lists.where(F.col("m") <= LONG).unionByName(long.join(able.select("node"), "node", "left_semi"))
    thin = _open_lists(kept)
    removed(places, sets, shared, able, lists)
    return thin


def _block_pairs(key: tuple, rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, Iterator[tuple[int, int]]]:
    """Nodes, component labels and done marks of a block, and its
    cross-component pairs with enough collisions; a pair belongs to the least
    token that its prefixes share.  While the pairs are read, labels may be
    merged and nodes marked; pairs of two marked nodes are left out."""
    tokens = rows["tokens"].combine_chunks().flatten().to_numpy().reshape(-1, COORDS)
    prefix = [frozenset(p) for p in rows["prefix"].to_pylist()]
    size, node, side = (rows[c].to_numpy() for c in ("n", "node", "side"))
    label = pd.factorize(rows["root"].to_numpy())[0]
    done = np.zeros(len(node), bool)
    token, same = key[0].as_py(), key[1].as_py() == key[2].as_py()
    low = np.ascontiguousarray(tokens.T.astype(np.uint16))  # equal tokens have equal low bits

    def pairs() -> Iterator[tuple[int, int]]:
        for i in range(len(node)):
            other = (label[:i] != label[i]) & (100 * np.minimum(size[:i], size[i]) >= percent * np.maximum(size[:i], size[i]))
            if not same:
                other &= side[:i] != side[i]
            near = np.flatnonzero(other & ((low[:, :i] == low[:, i:i + 1]).sum(0, dtype=np.uint8) >= MATCHES))
            for j in near[(tokens[near] == tokens[i]).sum(1) >= MATCHES].tolist():
                if label[j] != label[i] and not (done[i] and done[j]) and min(prefix[i] & prefix[j]) == token:
                    yield i, j

    return node, label, done, pairs()


def _candidates(percent: int):
    """The nodes of a block that have a pair to be compared."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        node, _, done, pairs = _block_pairs(key, rows, percent)
        for i, j in pairs:
            done[[i, j]] = True
        found = np.flatnonzero(done)
        return pa.table({c: pa.array([key[k].as_py()] * len(found), t) for k, (c, t) in enumerate(
            (("token", pa.int64()), ("lo", pa.int32()), ("hi", pa.int32())))}
            | {"node": rows["node"].take(pa.array(found)), "side": rows["side"].take(pa.array(found))})

    return run


def _compare_block(percent: int):
    """Links between the components of a block, by full sets."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        node, label, _, pairs = _block_pairs(key, rows, percent)
        sets, out = rows["members"].combine_chunks(), []
        for i, j in pairs:
            a, b = sets[i].values.to_numpy(), sets[j].values.to_numpy()
            common = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * common >= percent * (len(a) + len(b) - common):
                out.append((node[i], node[j]))
                label[label == label[j]] = label[i]
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _rest(lists: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Written links of all cross-component pairs of the open lists, block against block: first
    by signatures, which leaves few nodes, then these by full sets."""
    blocks = F.ceil(F.col("m") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("node", "token"), F.col("blocks")).cast("int")
    dealt = (lists.withColumn("blocks", blocks).withColumn("side", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("token", "node", "side", F.least("side", "other").alias("lo"), F.greatest("side", "other").alias("hi"))
             .distinct())
    known = nodes.join(lists.select("node", "root").distinct(), "node").select("node", "root", "n", "tokens", "prefix")
    left = saved(dealt.join(known, "node").groupBy("token", "lo", "hi")
                 .applyInArrow(_candidates(percent), "token long, lo int, hi int, node long, side int"), "left")
    sets = _full_sets(texts, nodes.select("node", "doc_id").join(left.select("node"), "node", "left_semi"), width)
    links = saved(left.join(known, "node").join(sets, "node").groupBy("token", "lo", "hi")
                  .applyInArrow(_compare_block(percent), "a long, b long"), "links")
    removed(left, sets)
    return links


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles,
    component_id (least doc_id reachable over links), kept, text_key."""
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    sigs = saved(texts.mapInArrow(_signatures(width), "doc_id long, text_key long, n long, node long, tokens array<long>"),
                 "signatures")
    nodes = (sigs.where("node is not null").groupBy("node")
             .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("tokens").alias("tokens")))
    nodes = saved(nodes, "nodes")
    # What later steps read of all documents is narrow; wide tables go once they are read.
    rows = saved(sigs.select("doc_id", "text_key", "n", "node"), "rows")
    removed(sigs)

    core = _core(nodes.select("node", F.explode("tokens").alias("token")))
    posted = core.select("node", F.slice("shared", F.lit(1), F.size("shared") - (MATCHES - 1)).alias("prefix"))
    involved = saved(nodes.join(posted, "node"), "involved")
    held = saved(nodes.select("node", "doc_id"), "held")
    removed(core, nodes)
    posts = involved.select("node", F.explode("prefix").alias("token"))
    leaders = _held(posts, F.count("*").alias("m"), F.min("node").alias("leader"))
    lists = saved(posts.join(leaders, "token"), "lists")
    removed(leaders)

    roots = links = None
    for _ in range(2):
        pairs = (lists.where("node <> leader")
                 .select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct())
        found = _confirmed(pairs, involved, texts, width, percent)
        links = found if links is None else links.union(found).distinct()
        roots = _merge(roots, found)
        lists = _next_lists(lists, roots, links)
    lists = _thinned(lists, held, texts, width, percent)
    roots = _merge(roots, _rest(lists, involved, texts, width, percent))
    removed(lists, involved)

    least = saved(roots.join(held, "node").groupBy("root").agg(F.min("doc_id").alias("component_id")), "least")
    of_node = (held.select("node", F.col("doc_id").alias("own")).join(roots, "node", "left").join(least, "root", "left")
               .select("node", F.coalesce("component_id", "own").alias("component_id")))
    out = rows.select("doc_id", "text_key", F.col("n").alias("n_shingles"), "node").join(of_node, "node", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"), "text_key")




def without_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, with its own columns: the one of least
    doc_id, of rows that share it the one of least text hash.  Rows without
    doc_id stay unless their texts are near another's; rows alike in doc_id
    and text are one."""
    return beside(docs, lambda rows: _without_duplicates(rows, width, percent))


def _without_duplicates(docs: DataFrame, width: int, percent: int) -> DataFrame:
    judged = near_duplicates(docs, width, percent).where("kept")
    one = F.min("text_key").over(Window.partitionBy("component_id", F.when(F.col("component_id").isNull(), F.col("text_key"))))
    chosen = (judged.withColumn("one", one).where("text_key = one")
              .groupBy(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key")).agg(F.count("*").alias("_n")))
    rows = docs.withColumn("_text", F.xxhash64("text")).join(
        chosen, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_key")))
    return (rows.where("_n = 1").unionByName(rows.where("_n > 1").dropDuplicates(["_id", "_key"])).select(*docs.columns))

"""Document fingerprints by one-permutation MinHash, DataFrame functions only.

The distinct ``WIDTH``-word shingles of a text are hashed once; the top bits
of a hash name one of ``BINS`` bins and a bin keeps its least hash.  An empty
bin takes the value of the first filled bin among those that hashes of its own
number name one after the other (optimal densification).  Of each bin ``BITS`` low-order bits
are stored, packed as hexadecimal; the share of equal bins is corrected for
chance matches, (share - 2^-b) / (1 - 2^-b), and held within 0 to 1.

All of it is array work within a row: a text's hashes are sorted with one mark
for each bin, which puts bins side by side.  A text of fewer words than the shingle is one shingle.  Null and
empty texts have the fingerprint '' (likeness 1 to each other, 0 to others).
Equal texts have equal fingerprints; words are compared as they stand.

Documents in order of falling doc_id (equal ones by text, nulls last) are cut
into ranges of some ``RANGE_ROWS`` rows, so their number grows with the table:
coarse ones at quantiles of doc_id, each cut again at its own quantiles, or by
the hash of the text where it is one doc_id (or null) alone.  Each range
borrows the first document of the next, so no step orders all rows in one task.
Only rows alike in doc_id and text can't be told apart and share a range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollwise.llm.common import bind, saved, stream, text_or_empty, words_col

WIDTH = 5
BINS = 128
BITS = 8
PROBES = 16
RANGE_ROWS = 1024
#: Quantiles of the first cut.
COARSE = 1024
_BIN_BITS = BINS.bit_length() - 1


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """64-bit hashes of the word shingles of a text, repeated as they repeat."""

    def windows(h: Column) -> Column:
        n = F.size(h)
        many = F.transform(F.slice(h, 1, F.greatest(n - (width - 1), F.lit(0))),
                           lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, width)]))
        short = F.when(n > 0, F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), " ")))).otherwise(
            F.array().cast("array<bigint>"))
        return F.when(n >= width, many).otherwise(short)

    return bind(F.transform(words_col(text), lambda w: F.xxhash64(w)), windows)


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - _BIN_BITS)


#: The last hash of each bin marks it as empty, in the order of sorted hashes.
_LAST = sorted(((b << (64 - _BIN_BITS)) | ((1 << (64 - _BIN_BITS)) - 1)) - ((b >= BINS // 2) << 64) for b in range(BINS))
_HEX = [f"{v:0{BITS // 4}x}" for v in range(1 << BITS)]


def _probe(b: Column, attempt: int) -> Column:
    """The bin that an empty one asks at an attempt: a 2-universal hash."""
    first, second = (int(x) % 8191 for x in stream(23 + attempt, 2))
    return F.pmod((b * (first + 1) + second) % 8191, F.lit(BINS))


def fingerprint(hashes: Column) -> Column:
    """Packed low-order bits of the densified bins, '' for no shingle."""
    digits = F.array(*map(F.lit, _HEX))  # folded to one literal
    marks = F.array(*map(F.lit, _LAST))

    def filled(h: Column) -> Column:
        """Least hash of each bin in order, null for an empty one."""
        heads = bind(F.sort_array(F.concat(h, marks)),
                     lambda s: F.filter(s, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(s, i - 1)))))
        rest = F.lit((1 << (64 - _BIN_BITS)) - 1)
        return F.transform(heads, lambda x: F.when(x.bitwiseAND(rest) != rest, x))

    def dense(d: Column) -> Column:
        def value(x: Column, b: Column) -> Column:
            turn = _probe(b, PROBES) + 1  # after the attempts, the next filled bin from a drawn one on
            rest = F.filter(F.concat(F.slice(d, turn, F.lit(BINS)), F.slice(d, F.lit(1), turn - 1)), lambda v: v.isNotNull())
            return F.coalesce(x, *(F.get(d, _probe(b, k)) for k in range(PROBES)), F.get(rest, F.lit(0)))

        # Bits that do not name the bin, mixed once more.
        return F.array_join(F.transform(d, lambda x, b: F.get(digits, F.xxhash64(value(x, b)).bitwiseAND(
            F.lit((1 << BITS) - 1)).cast("int"))), "")

    return bind(hashes, lambda h: F.when(F.size(h) == 0, F.lit("")).otherwise(bind(filled(h), dense)))


def likeness(a: Column, b: Column) -> Column:
    """Bias-corrected share of equal bins of two fingerprints."""
    step = 32 // BITS  # bins in a 32-bit part, of BITS // 4 signs each
    part = lambda fp, i: F.conv(F.substr(fp, i * 8 + 1, F.lit(8)), 16, 10).cast("bigint")
    low = F.lit(sum((1 << (BITS - 1)) - 1 << BITS * k for k in range(step)))

    def equal(x: Column) -> Column:
        # One high bit for each of the parts of ``x`` that is 0.
        some = ((x.bitwiseAND(low) + low).bitwiseOR(x)).bitwiseOR(low)
        return F.lit(step) - F.bit_count(some.bitwiseXOR(low))

    same = F.aggregate(F.sequence(F.lit(0), F.lit(BINS // step - 1)), F.lit(0),
                       lambda n, i: n + equal(part(a, i).bitwiseXOR(part(b, i))).cast("int"))
    estimate = (same / F.lit(float(BINS)) - 2.0 ** -BITS) / (1 - 2.0 ** -BITS)
    return F.when(a == b, F.lit(1.0)).when((a == "") | (b == ""), F.lit(0.0)).otherwise(
        F.least(F.greatest(estimate, F.lit(0.0)), F.lit(1.0)))


def _rank(bounds: Column, size: int | Column, x: Column) -> Column:
    """How many of ``bounds``, sorted, are below ``x``, by halving."""
    steps = F.lit([1 << k for k in reversed(range(max(1, size.bit_length())))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) < x, at + step).otherwise(at))


def _literal(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")  # folded to one literal


def _quantiles(n: int) -> Column:
    return F.percentile_approx("doc_id", [k / n for k in range(1, n)], 20 * n)


def _placed(rows: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """``rows`` (doc_id, key, ...) with coarse and place (greater ones come first),
    and the coarse ranges held, each with the next one's number."""
    n = rows.count()
    cuts = max(2, min(COARSE, -(-n // RANGE_ROWS)))
    found = rows.select(_quantiles(cuts)).first()[0] or []
    # A doc_id of several quantiles has a range of its own.
    bounds = sorted({*found, *(b - 1 for b, after in zip(found, found[1:]) if b == after and b > -2 ** 63)})
    rank = _rank(_literal(bounds), len(bounds), F.col("doc_id")) if bounds else F.lit(0)
    rows = rows.withColumn("coarse", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(rank))
    sizes = (rows.groupBy("coarse").agg(F.count("*").alias("n"), F.min("doc_id").eqNullSafe(F.max("doc_id")).alias("one"))
             .collect())  # 2 COARSE + 2 rows at most
    many = {r["coarse"]: -(-r["n"] // RANGE_ROWS) for r in sizes if not r["one"]}
    parts = {r["coarse"]: -(-r["n"] // RANGE_ROWS) for r in sizes if r["one"]}
    most = max(2, *many.values()) if many else 2
    # No doc_id holds more than two coarse ranges' rows here, so one number of cuts fits all.
    fine = saved(rows.where(F.col("coarse").isin([c for c, k in many.items() if k > 2])).groupBy("coarse")
                 .agg(_quantiles(most).alias("fine")), "ranges")
    by_hash = F.col("parts") - 1 - F.least(F.floor((F.col("key") / 2.0 ** 64 + 0.5) * F.col("parts")), F.col("parts") - 1)
    alone = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair]) if parts else F.create_map().cast("map<int,int>")
    # Written, so that the join broadcasts the cuts by their real size.
    rows = rows.join(fine, "coarse", "left").withColumn("parts", F.try_element_at(alone, F.col("coarse")).cast("long"))
    sub = F.when(F.col("parts").isNotNull(), by_hash).when(F.col("fine").isNotNull(), _rank(F.col("fine"), most, F.col("doc_id"))).otherwise(0)
    rows = rows.withColumn("place", F.shiftleft(F.col("coarse").cast("long"), 32) + sub.cast("long")).drop("fine", "parts")
    held = sorted((r["coarse"] for r in sizes), reverse=True)
    return rows, dict(zip(held, [*held[1:], *held[:1]]))


def _lent(placed: DataFrame, after: dict[int, int]) -> DataFrame:
    """The first row of each place (text), under the place that comes before it."""
    heads = saved(placed.groupBy("coarse", "place").agg(F.max(F.struct("doc_id", F.bitwise_not("key").alias("less"))).alias("head"))
                  .select("coarse", "place", "head.doc_id", F.bitwise_not("head.less").alias("key")), "heads")
    ends = {r["coarse"]: r for r in heads.groupBy("coarse").agg(F.min("place").alias("lo"), F.max("place").alias("hi")).collect()}
    before = F.lead("place").over(Window.partitionBy("coarse").orderBy("place"))
    wraps = [F.lit(x) for c, nxt in after.items() for x in (ends[nxt]["hi"], ends[c]["lo"])]
    heads = heads.withColumn("to", F.coalesce(before, F.create_map(*wraps)[F.col("place")] if wraps else F.lit(None).cast("long")))
    first = placed.alias("p").join(heads.drop("coarse").alias("h"), (F.col("p.place") == F.col("h.place")) & (F.col("p.key") == F.col("h.key"))
                                   & F.col("p.doc_id").eqNullSafe(F.col("h.doc_id")))
    return first.groupBy(F.col("h.to").alias("place")).agg(F.min("p.text").alias("text"))


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, fp and next_text, next_fp: the next row by falling doc_id, after the last the first."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    placed, after = _placed(rows.withColumn("key", F.xxhash64("text")))
    own = placed.select("place", "doc_id", "key", "text", F.lit(True).alias("own"))
    lent = _lent(placed, after).select("place", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("key"), "text",
                                       F.lit(False).alias("own"))
    both = own.unionByName(lent).withColumn("fp", fingerprint(shingle_hashes(F.col("text"))))
    w = Window.partitionBy("place").orderBy(F.col("own").desc(), F.col("doc_id").desc_nulls_last(), "key", "text")
    return (both.withColumn("next", F.lead(F.struct("text", "fp")).over(w)).where("own")
            .select("doc_id", "text", "fp", F.col("next.text").alias("next_text"), F.col("next.fp").alias("next_fp")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next."""
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - cut), F.substr(F.col("next_text"), F.lit(1), cut))
    rows = with_next(docs).withColumn("edited", edited)
    rows = rows.withColumn("edited_fp", fingerprint(shingle_hashes(F.col("edited"))))
    return rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                       F.col("fp").alias("fingerprint"), F.col("edited_fp").alias("edited_fingerprint"),
                       likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                       likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))

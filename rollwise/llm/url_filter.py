"""URL rules looked up in a sorted, memory-mapped array of 64-bit digests.

A rule is a host and a path prefix; it fits the host, its subdomains and every
path that starts with the prefix.  ``write_rules`` lays the rules out in one
file: the xxhash64 keys in ascending order, where each rule's text starts, its
verdict, and the texts.  Rules are sorted by Spark and streamed to the file in
that order, ``CHUNK`` at a time; Spark ships the file to the executors
(``SparkContext.addFile``), where tasks memory-map it: a task reads the pages
that its probes touch, however many rules there are.

Per batch of URLs every (host suffix, path prefix) that has the lengths of some
rule becomes a candidate; keys are probed by vectorised binary search, the run
of equal keys is walked, and the full strings are compared, so a collision of
digests decides nothing.  The longest rule wins (host and path together, then
host); of one rule given twice with two verdicts, block wins.

The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end,
A-Z lower-cased (ports and user names are part of it, so no rule fits them); the
path goes on up to ``?``, ``#`` or the end.  Null URLs and those without ``://``
have both empty.  Where no rule fits the rule is null and the verdict that of
the method: a URL that the array does not list is allowed.  Repeated rows each
give a row, empty tables none; other columns of the input are not read.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollwise.session import fresh_path

#: Rules that the driver holds at a time while it writes the file.
CHUNK = 1 << 16
MAGIC = b"urlrules"
UNLISTED = "allow"
SCHEMA = "host string, path string, verdict string"


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def key_of(host: bytes, path: bytes) -> int:
    """Digest of a rule; the sign that parts host and path occurs in no host."""
    return xxhash.xxh64_intdigest(host + b"/" + path)


def _sorted_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules (key, host, path, blocked) in order of key."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [key_of(h.encode(), p.encode()) for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            # Unsigned order is that of the signed number with the top bit turned.
            order = (np.array(keys, np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(order), *b.columns], names=["key", "host", "path", "blocked"])

    lower = F.translate("host", string.ascii_uppercase, string.ascii_lowercase)
    one = (rules.where("host is not null and host <> ''").select(lower.alias("host"), F.coalesce("path", F.lit("")).alias("path"),
                                                                (F.col("verdict") == "block").alias("blocked"))
           .groupBy("host", "path").agg(F.max("blocked").alias("blocked")))
    return one.mapInArrow(keyed, "key long, host string, path string, blocked boolean").orderBy("key", "host", "path")


def write_rules(spark: SparkSession, rules: DataFrame) -> str:
    """Writes the array to the shared folder and ships it; returns its file name."""
    ordered = _sorted_rules(rules)
    n = ordered.count()
    path = fresh_path(spark, "url-rules")
    jvm = spark._jvm.org.apache.hadoop.fs
    at = jvm.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())

    def stream(name: str, parts: Iterable[bytes]) -> None:
        out = fs.create(jvm.Path(f"{path}.{name}"), True)
        for part in parts:
            out.write(bytearray(part))
        out.close()

    def chunks() -> Iterator[list]:
        held = []
        for row in ordered.toLocalIterator():
            held.append(row)
            if len(held) == CHUNK:
                yield held
                held = []
        if held:
            yield held

    shapes: set[tuple[int, int]] = set()

    def layout() -> Iterator[bytes]:
        """Keys first, then starts, verdicts and texts: one pass each over the sorted rules."""
        yield MAGIC + np.uint64(n).tobytes()
        for rows in chunks():
            yield (np.array([r.key for r in rows], np.int64).view(np.uint64) ^ np.uint64(1 << 63)).tobytes()
        start = 0
        for rows in chunks():
            sizes = np.array([(len(r.host.encode()), len(r.path.encode())) for r in rows], np.uint64)
            shapes.update(map(tuple, sizes.tolist()))
            ends = start + np.cumsum(sizes.sum(1))
            yield np.stack([ends - sizes.sum(1), sizes[:, 0], sizes[:, 1], np.array([r.blocked for r in rows], np.uint64)], 1).astype(
                np.uint64).tobytes()
            start = int(ends[-1])
        for rows in chunks():
            yield b"".join((r.host + r.path).encode() for r in rows)

    stream("bin", layout())
    stream("shapes", [np.array(sorted(shapes), np.uint64).reshape(-1, 2).tobytes()])
    for name in ("bin", "shapes"):
        spark.sparkContext.addFile(f"{path}.{name}")
    return path.rsplit("/", 1)[-1]


class Rules:
    """The memory-mapped array."""

    def __init__(self, path: str):
        self.shapes = np.fromfile(f"{path}.shapes", np.uint64).reshape(-1, 2).astype(np.int64).tolist()
        data = np.memmap(f"{path}.bin", np.uint8, "r")
        if data[:8].tobytes() != MAGIC:
            raise ValueError(f"{path}.bin is no rule file")
        n = int(data[8:16].view(np.uint64)[0])
        self.keys = data[16:16 + 8 * n].view(np.uint64)
        self.rows = data[16 + 8 * n:16 + 40 * n].view(np.uint64).reshape(n, 4)
        self.texts = data[16 + 40 * n:]

    def find(self, keys: np.ndarray, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        """For each candidate its rule's number, else -1."""
        found = np.full(len(keys), -1, np.int64)
        at = np.searchsorted(self.keys, keys, "left")
        end = np.searchsorted(self.keys, keys, "right")
        left = np.flatnonzero(at < end)
        while len(left):
            for k in left.tolist():
                start, h, p, _ = (int(v) for v in self.rows[at[k]])
                if (h, p) == (len(hosts[k]), len(paths[k])) and self.texts[start:start + h + p].tobytes() == hosts[k] + paths[k]:
                    found[k] = at[k]
            at[left] += 1  # another rule with the same digest may follow
            left = left[(found[left] < 0) & (at[left] < end[left])]
        return found

    def longest(self, hosts: list[bytes], paths: list[bytes]) -> list[tuple[str, bool] | None]:
        """Of each URL the longest rule that fits, and whether it blocks."""
        row, host, path, keys = [], [], [], []
        for h_size, p_size in self.shapes:
            for k, (h, p) in enumerate(zip(hosts, paths)):
                if len(p) >= p_size and (len(h) == h_size or (len(h) > h_size and h[-h_size - 1] == 46)):
                    row.append(k)
                    host.append(h[len(h) - h_size:])
                    path.append(p[:p_size])
                    keys.append(key_of(host[-1], path[-1]))
        out: list[tuple[str, bool] | None] = [None] * len(hosts)
        best = [(-1, -1)] * len(hosts)
        for c, rule in enumerate(self.find(np.array(keys, np.uint64), host, path).tolist()):
            rank = (len(host[c]) + len(path[c]), len(host[c]))
            if rule >= 0 and rank > best[row[c]]:
                best[row[c]] = rank
                out[row[c]] = ((host[c] + path[c]).decode(), bool(self.rows[rule, 3]))
        return out


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """A row per row of ``pages`` (page_id, url): page_id, host, path, rule,
    verdict.  ``rules``: host, path, verdict (allow or block)."""
    name = write_rules(pages.sparkSession, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Rules(SparkFiles.get(name))
        for b in batches:
            hosts, paths = ([x.encode() for x in b.column(c).to_pylist()] for c in (1, 2))
            hits = table.longest(hosts, paths)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([h and h[0] for h in hits], pa.string()),
                 pa.array([UNLISTED if h is None else "block" if h[1] else "allow" for h in hits], pa.string())],
                names=["page_id", "host", "path", "rule", "verdict"])

    return (pages.select(F.col("page_id").cast("long").alias("page_id"), host_of(F.col("url")).alias("host"),
                         path_of(F.col("url")).alias("path"))
            .mapInArrow(run, "page_id long, host string, path string, rule string, verdict string"))


def parsed(rules: Iterable[str]) -> list[tuple[str, str, str]]:
    """Lines ``allow org/`` as rows (host, path, verdict)."""
    rows = []
    for line in rules:
        m = re.fullmatch(r"(allow|block) ([^/?#\s]+)(/\S*)?", line)
        if not m:
            raise ValueError(f"no rule: {line!r}")
        rows.append((m[2], m[3] or "", m[1]))
    return rows

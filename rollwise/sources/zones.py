"""Zone maps: which control times each file of a source holds.

A target's chunks are cut on a control time that a transformation computes, so
a range of it prunes nothing in a scan.  Per file of the source table the map
keeps the least and greatest control time and, for a source that names its
raw time column, the least and greatest difference of the two.  A range run
then reads the files whose zone meets the range and pushes a raw-time bound
that the differences prove.  Both come from the data: a late row widens its
file's zone, so no row is lost and nothing has to be declared.

The map is append-only parquet next to the target.  Files are immutable and
known by path, size and modification time; each refresh scans only files it
does not know yet, by the control columns alone.  A file that vanished or was
rewritten is told by the current listing.  The folder's name holds the
semantic hash of the control expression: another transformation has another map.

A map proves something only when every row comes from one file of the source
table: rows made by a shuffle (joins, windows, aggregates in the
transformation) or of other files leave the source without a map, and so does
a transformation that reads the table more than once.  Such a source, and
one that is no file table, is read whole.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.aggregate import time_col
from ..specs import SourceSpec, TargetSpec
from .catalog import Catalog, resolve_source

_SCHEMA = ("file string, size bigint, modified timestamp, lo timestamp_ntz, hi timestamp_ntz, "
           "off_lo bigint, off_hi bigint, no_raw bigint, alien boolean")
_FILE = ["file", "size", "modified"]


@dataclass
class Narrowed:
    """What a range of control time needs of a source."""
    catalog: Catalog                 # the source table reduced to the files in question
    offsets: tuple[int, int] | None  # proven bounds of control - raw time, microseconds
    files: int | None                # how many files; None: all (no map)


class ZoneMap:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- the source's files ------------------------------------------------------

    @staticmethod
    def _listing(base: DataFrame) -> DataFrame | None:
        """Current files of a table, from the hidden metadata column."""
        try:
            return base.select(F.col("_metadata.file_path").alias("file"),
                               F.col("_metadata.file_size").alias("size"),
                               F.col("_metadata.file_modification_time").alias("modified")).distinct()
        except AnalysisException:  # no file table
            return None

    @staticmethod
    def _read_once(base: DataFrame, resolved: DataFrame) -> bool:
        leaves = resolved._jdf.queryExecution().analyzed().collectLeaves()
        own = base._jdf.queryExecution().analyzed().collectLeaves()
        return own.size() == 1 and sum(
            leaves.apply(i).sameResult(own.apply(0)) for i in range(leaves.size())) == 1

    @staticmethod
    def _only(catalog: Catalog, name: str, files: list[str]) -> Catalog:
        """The catalog with one table reduced to some files (pruned at planning)."""
        path = F.col("_metadata.file_path")
        return catalog.with_table(name, catalog.table(name).where(
            path.isin(files) if files else F.lit(False)))

    def _folder(self, resolved: DataFrame, target: TargetSpec, source: SourceSpec) -> str:
        control = target.source_of(target.control_column)
        raw = [source.control_column] if source.control_column in resolved.columns else []
        mark = resolved.select(F.col(control).alias("c"), *[F.col(c).alias("r") for c in raw]).semanticHash()
        return f"{self.root}/{source.source_table}-{mark & 0xFFFFFFFF:08x}"

    def _known(self, folder: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], _SCHEMA)
        return self.spark.read.schema(_SCHEMA).parquet(folder)

    # ---- build and use -----------------------------------------------------------

    def refresh(self, catalog: Catalog, target: TargetSpec, source: SourceSpec) -> bool:
        """Add the files that are new to the map.  False: the source has none."""
        base = catalog.table(source.source_table)
        listing, resolved = self._listing(base), resolve_source(catalog, source)
        if listing is None or not self._read_once(base, resolved):
            return False
        folder = self._folder(resolved, target, source)
        known = self._known(folder)
        aliens = known.where("alien").select(*_FILE, F.lit(True).alias("alien")).limit(1)
        found = (listing.join(known.select(*_FILE), _FILE, "left_anti").withColumn("alien", F.lit(False))
                 .unionByName(aliens).collect())  # a row per new file
        if any(r.alien for r in found):
            return False
        if fresh := [(r.file, r.size, r.modified) for r in found]:
            if listing.count() > len(fresh):
                resolved = resolve_source(self._only(catalog, source.source_table, [f for f, _, _ in fresh]), source)
            rows = self.spark.createDataFrame(fresh, "file string, size bigint, modified timestamp")
            zones = self._zones(resolved, target, source)
            (rows.join(zones.withColumn("_zone", F.lit(True)), "file", "full_outer")
             .select(*_FILE, "lo", "hi", "off_lo", "off_hi", "no_raw",
                     F.col("size").isNull().alias("alien")).coalesce(1).write.mode("append").parquet(folder))
            return self._known(folder).where("alien").limit(1).count() == 0
        return True

    @staticmethod
    def _zones(resolved: DataFrame, target: TargetSpec, source: SourceSpec) -> DataFrame:
        t = time_col(resolved, target.source_of(target.control_column))
        if source.control_column and source.control_column in resolved.columns:
            raw = time_col(resolved, source.control_column)
            off = F.timestamp_diff("MICROSECOND", raw, t)
            offsets = [F.min(off).alias("off_lo"), F.max(off).alias("off_hi"),
                       F.count_if(t.isNotNull() & raw.isNull()).alias("no_raw")]
        else:
            offsets = [F.lit(None).cast("bigint").alias(c) for c in ("off_lo", "off_hi", "no_raw")]
        # A local file is file:/a in the listing and file:///a here.
        name = F.regexp_replace(F.input_file_name(), "^file:/+", "file:/")
        return (resolved.groupBy(name.alias("file"))
                .agg(F.min(t).alias("lo"), F.max(t).alias("hi"), *offsets))

    def _current(self, catalog: Catalog, target: TargetSpec, source: SourceSpec) -> DataFrame | None:
        """Listed files with their zones (``seen`` null: not known), and a row
        with ``alien`` when the map proves nothing."""
        base = catalog.table(source.source_table)
        listing, resolved = self._listing(base), resolve_source(catalog, source)
        if listing is None or not self._read_once(base, resolved):
            return None
        known = self._known(self._folder(resolved, target, source))
        zones = known.where("not alien").groupBy(*_FILE).agg(  # two refreshes at a time may add a file twice
            F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.min("off_lo").alias("off_lo"),
            F.max("off_hi").alias("off_hi"), F.max("no_raw").alias("no_raw"), F.lit(True).alias("seen"))
        return listing.join(zones, _FILE, "left").withColumn("alien", F.lit(False)).unionByName(
            known.where("alien").limit(1).select("alien"), allowMissingColumns=True)

    def narrowed(self, catalog: Catalog, target: TargetSpec, source: SourceSpec,
                 lo: dt.datetime, hi: dt.datetime) -> Narrowed:
        """The files that can hold control times in ``[lo, hi)``; a file that
        the map does not know yet is among them."""
        current = self._current(catalog, target, source)
        if current is None:
            return Narrowed(catalog, None, None)
        meets = (F.col("hi") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("lo") < F.lit(hi).cast("timestamp_ntz"))
        rows = current.where(F.col("alien") | F.col("seen").isNull() | meets).select(
            "file", "off_lo", "off_hi", "no_raw", "alien").collect()  # a row per file to read
        if any(r.alien for r in rows):
            return Narrowed(catalog, None, None)
        proven = all(r.off_lo is not None and r.no_raw == 0 for r in rows) and rows
        offsets = (min(r.off_lo for r in rows), max(r.off_hi for r in rows)) if proven else None
        return Narrowed(self._only(catalog, source.source_table, [r.file for r in rows]), offsets, len(rows))

    def latest(self, catalog: Catalog, target: TargetSpec, source: SourceSpec) -> DataFrame | None:
        """One row ``latest_ts``: the newest control time, from the map alone.
        None: the source has no (complete) map."""
        current = self._current(catalog, target, source)
        if current is None or current.where("seen is null").limit(1).count():
            return None  # an alien row is not seen either
        return current.agg(F.max("hi").alias("latest_ts"))

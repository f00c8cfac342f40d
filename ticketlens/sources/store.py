"""Ingest once, query many: the citation table as partitioned parquet.

Building the citation table is the expensive step (CSV parsing for the real
files, a four-table join for the fixture). The analyses then read a narrow,
columnar table. ``stored`` **runs a job**: it writes a built DataFrame as
parquet and hands back a scan of it. The write also cuts the lineage: a lost
executor costs a re-read of parquet files, not a re-run of the join.

The table belongs to this application: a folder below the one that
``spark.checkpoint.dir`` names, which ``forget`` removes. A table that outlives the application and grows with its source
files is the matter of ``sources.yearly``.

Rows are rebalanced on the partition columns before the write, with AQE
splitting large folders into advisory-size tasks. ``stored_citations`` adds a second partition level
for the year filter, so "clean rows" is partition pruning.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import YEAR_COL
from ..session import CHECKPOINT_KEY
from .footers import column_ranges, footer_counts
from .layout import LOOKUP_COLS, ordered

_LOCK = threading.RLock()
_KEY_LOCKS: dict[tuple[str, str], threading.RLock] = defaultdict(threading.RLock)
# (application id, name) -> scan of the written table. Holding the scan keeps
# its file listing, so later queries skip listing and footer reads.
_STORED: dict[tuple[str, str], DataFrame] = {}
_VIEWS: dict[tuple[str, str], tuple[DataFrame, DataFrame]] = {}
_YEARS: dict[tuple[str, str], list[int]] = {}
_RANGES: dict[tuple[str, str], dict[int, tuple[int, int]]] = {}
_OWN_PATHS: dict[tuple[str, str], str] = {}
_DIRS: dict[str, str] = {}

IN_YEAR_COL = "in_file_year"
MAX_RECORDS_PER_FILE = 10_000_000


def _app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no SparkContext
        return None


def _lock_of(key: tuple[str, str]) -> threading.RLock:
    """One lock for each table, so that ingests of different tables don't wait for each other."""
    with _LOCK:
        return _KEY_LOCKS[key]


def ensure_shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, the same at every call.

    If the setting is absent and the master is local (tests, a laptop), a
    fresh temporary folder is set. On a cluster an absent setting is an
    error: a machine-local folder would not survive a lost executor.
    """
    sc = _context(spark)
    app = _app_id(spark) if sc is None or hasattr(sc, "applicationId") else None
    with _LOCK:
        if app in _DIRS:
            return _DIRS[app]
        current = spark.conf.get(CHECKPOINT_KEY, None) or (sc.getCheckpointDir() if sc is not None else None)
        if not current:
            master = sc.master if sc is not None else (spark.conf.get("spark.master", None) or "")
            if not master.startswith("local"):
                raise RuntimeError(f"set {CHECKPOINT_KEY} to a shared folder before running on a cluster")
            current = tempfile.mkdtemp(prefix="run-")
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        if app is not None:
            _DIRS[app] = current.rstrip("/")
        return current.rstrip("/")


def own_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application below the shared one, the same for one name; ``forget`` removes it."""
    key = (_app_id(spark), name)
    with _LOCK:
        if key not in _OWN_PATHS:
            safe = re.sub(r"[^0-9A-Za-z_.-]+", "_", name).strip("_")[-80:]
            _OWN_PATHS[key] = f"{ensure_shared_dir(spark)}/ticketlens/{safe}-{uuid.uuid4().hex[:12]}"
        return _OWN_PATHS[key]


def spooled(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared folder and read back, for a result that several later steps use.

    Cuts the lineage as ``stored`` does, under a fresh name at every call; ``forget`` removes it.
    """
    path = own_folder(df.sparkSession, f"spool-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(
    spark: SparkSession,
    name: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (YEAR_COL,),
    sort_by: Sequence[str] = (),
    formed: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """Scan of ``build()``, written by a job of this call unless it was before.

    ``name`` must tell apart whatever ``build`` makes of different arguments. ``sort_by``
    orders the rows within files, so a filter on these columns passes over the row groups and
    pages without a match; the order begins with the partition columns, by which a task writes
    anyway. ``formed`` makes the table's rows of the built ones, row by row, once these are dealt to their
    tasks: what it adds crosses no shuffle.
    """
    key = (_app_id(spark), name)
    with _lock_of(key):
        if key not in _STORED:
            path = own_folder(spark, name)
            # A first write that failed leaves files without a handle: they are written over.
            dealt = built = formed(build().hint("rebalance", *partition_by))
            if sort_by:
                dealt = ordered(dealt, partition_by, sort_by)
            (
                dealt.write.mode("overwrite")
                .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
                .partitionBy(*partition_by)
                .parquet(path)
            )
            # Read back with the built schema: partition columns keep their
            # types (a boolean folder value would otherwise be inferred as
            # text) and no footer-reading job is needed to plan the scan.
            _STORED[key] = spark.read.schema(built.schema).parquet(path).select(*built.columns)
        return _STORED[key]


def stored_citations(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], formed: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> tuple[DataFrame, DataFrame]:
    """Store a citation table once; return ``(all rows, clean rows)``.

    ``build`` may leave all columns but ``file_year`` and ``issue_date`` to ``formed``, which keeps those that it doesn't know.

    The table is partitioned by ``file_year`` and by ``in_file_year``, the
    year-filter predicate evaluated once at ingest. The clean view is then a
    partition filter: its scans open only the folders of kept rows.
    """
    from ..operators.clean import issued_in_file_year

    key = (_app_id(spark), name)
    with _lock_of(key):
        if key not in _VIEWS:
            scan = stored(
                spark,
                name,
                lambda: build().withColumn(IN_YEAR_COL, issued_in_file_year()),
                partition_by=(YEAR_COL, IN_YEAR_COL),
                sort_by=LOOKUP_COLS,
                formed=formed,
            )
            cols = [c for c in scan.columns if c != IN_YEAR_COL]
            _VIEWS[key] = (scan.select(*cols), scan.where(F.col(IN_YEAR_COL)).select(*cols))
        return _VIEWS[key]


def stored_years(spark: SparkSession, name: str) -> list[int]:
    """The years of a table that ``stored_citations`` wrote in this application, in order.

    One row per folder comes to the driver, once per application, from file footers.
    """
    key = (_app_id(spark), name)
    with _lock_of(key):
        if key not in _YEARS:
            _YEARS[key] = sorted({r[YEAR_COL] for r in folder_counts(spark, name).collect()})
        return _YEARS[key]


def folder_counts(spark: SparkSession, name: str) -> DataFrame:
    """Rows of each folder of a table that ``stored_citations`` wrote: ``file_year, in_file_year, n``, from file footers."""
    schema = _STORED[(_app_id(spark), name)].schema
    return footer_counts(spark, own_folder(spark, name), schema, [YEAR_COL, IN_YEAR_COL])


def clean_ranges(spark: SparkSession, name: str, column: str) -> dict[int, tuple[int, int]]:
    """Least and largest value of an integral column in each year's clean rows, from file footers, asked once."""
    key = (_app_id(spark), f"{name}:{column}")
    with _lock_of(key):
        if key not in _RANGES:
            schema = _STORED[(_app_id(spark), name)].schema
            found = column_ranges(spark, own_folder(spark, name), schema, [YEAR_COL, IN_YEAR_COL], column)
            _RANGES[key] = {year: (lo, hi) for (year, clean), lo, hi in found if clean and lo is not None}
        return _RANGES[key]


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """Keep ``df`` cached while a block reuses it; release it afterwards.

    For a narrow projection read by several actions in a row. Cached blocks
    live on executors; a lost executor's blocks are recomputed from lineage.
    """
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def forget(spark: SparkSession) -> None:
    """Drop this application's stored-table handles and remove the files that it owns.

    Tables that the caller named a folder for stay.
    """
    app = _app_id(spark)
    with _LOCK:
        for cache in (_STORED, _VIEWS, _YEARS, _RANGES):
            for key in [k for k in cache if k[0] == app]:
                del cache[key]
        own = [_OWN_PATHS.pop(k) for k in list(_OWN_PATHS) if k[0] == app]
    sc = _context(spark)
    for path in own if sc is not None else ():
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)

"""A durable citation table of yearly CSV files that grows by years.

``store_years`` brings a table up to date with its source files: years whose files,
columns or types are not those of the last load are read and written, all
others are left as they are. A table is a folder with

* ``data/load=<id>/file_year=<year>/…``: a load of one year as Parquet, below it a
  folder level for broken records and one for the year filter. No load is ever
  overwritten, so those who read an older state go on undisturbed;
* ``sources/load=<id>/…``: the load's source files with size, time and digest;
* ``manifest/version=<n>-<id>/…``: one row for each year that names its load, its
  fingerprint, types and counts. A version is one small file written last: it is the
  commit. A load that a killed job left behind is in no version and is never read.

On opening, the data files of each load are listed and held against the
number and bytes in the manifest: a year with files missing or cut is refused by ``open_years`` and
read from its source again by ``store_years``.

The fingerprint of a year covers path, size and time of change of its files, and the way they were
read; with ``content=True`` a digest of their lines takes the place of the time, at the cost of one
pass over the text, so that copied files are known again. Counts of rows, broken records and
unreadable cells are observed while the load is written, without a pass of their own.

Broken records (too many or too few cells, an open quote) are stored as text beside the
row that the reader made of them. ``broken="keep"``, the reference's way, has these rows in
the table; ``broken="quarantine"`` leaves them out. ``broken_records`` lists them either way.

What comes to the driver are a table's years, its loads' counts and its types. One writer at a
time: two that commit the same version at once are told so.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.clean import issued_in_file_year
from ..schema import TICKET_COLUMNS, YEAR_COL, build_name
from .csv import BROKEN_COL, SOURCE_COL, Part, inferred, parts_of, year_of
from .layout import indexed, ordered
from .store import IN_YEAR_COL, MAX_RECORDS_PER_FILE, own_folder
from .types import stated

#: The folder level that parts broken records from the rest.
BROKEN = "is_broken"
ENTRY_SCHEMA = (
    "file_year int, load string, fingerprint string, inferred string, columns string, data_files long, data_bytes long, "
    "rows long, broken long, unreadable string"
)
#: Years that are listed or loaded at the same time.
YEARS_AT_ONCE = 4
_LOCKS: dict[str, threading.RLock] = defaultdict(threading.RLock)


class DamagedTable(RuntimeError):
    """A committed load whose files are not those that were written."""


@dataclass(frozen=True)
class Entry:
    """A year of a version: where its rows are, and what they were made of."""

    file_year: int
    load: str
    fingerprint: str
    inferred: str
    columns: str
    data_files: int
    data_bytes: int
    rows: int
    broken: int
    unreadable: str

    def folder(self, target: str) -> str:
        return f"{target}/data/load={self.load}/{YEAR_COL}={self.file_year}"


def _files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path``, ``length`` and ``modificationTime`` of the files, by a listing alone."""
    return spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")


def listed(spark: SparkSession, paths: Sequence[str], content: bool = False) -> DataFrame:
    """A year's source files: ``path``, ``length``, ``modified`` and, if asked for, a digest of the lines in any order."""
    files = _files(spark, paths).withColumnRenamed("modificationTime", "modified")
    if not content:
        return files.withColumn("lines", F.lit(None).cast("string"))
    line = F.sha2(F.col("value"), 256)
    digest = F.concat_ws(
        ":", F.count(F.lit(1)), *(F.hex(F.bit_xor(F.conv(F.substring(line, 1 + 15 * k, 15), 16, 10).cast("long"))) for k in range(4))
    )
    lines = spark.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), "value").groupBy("file").agg(digest.alias("lines"))
    return files.join(lines, files["path"] == F.col("file"), "left").drop("file")


def _fingerprints(spark: SparkSession, paths: Mapping[int, Sequence[str]], how: str, content: bool) -> dict[int, str]:
    """A digest of each year's source files and of the way they are read, by one job over all years' listings."""
    mark = F.coalesce("lines", F.lit("empty")) if content else F.date_format("modified", "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")
    files = [listed(spark, p, content).withColumn("year", F.lit(year)) for year, p in paths.items()]
    rows = F.array_sort(F.collect_list(F.concat_ws("|", "path", F.col("length").cast("string"), mark)))
    digest = F.sha2(F.concat_ws("\n", F.lit(how), rows), 256)
    found = reduce(DataFrame.unionByName, files).groupBy("year").agg(digest.alias("digest")).collect() if files else []
    return {r["year"]: r["digest"] for r in found}


def _versions(spark: SparkSession, target: str) -> DataFrame | None:
    try:
        return spark.read.schema(f"{ENTRY_SCHEMA}, version string").json(f"{target}/manifest")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def _latest(spark: SparkSession, target: str) -> tuple[int, dict[int, Entry]]:
    """The number of the last version, and its years."""
    rows = _versions(spark, target)
    last = rows.agg(F.max("version")).first()[0] if rows is not None else None
    if last is None:
        return 0, {}
    found = rows.where(F.col("version") == last).drop("version").collect()
    return int(last.split("-")[0]), {r["file_year"]: Entry(**r.asDict()) for r in found}


def _commit(spark: SparkSession, target: str, number: int, entries: Mapping[int, Entry]) -> None:
    rows = spark.createDataFrame([tuple(asdict(e).values()) for _, e in sorted(entries.items())], ENTRY_SCHEMA)
    rows.coalesce(1).write.mode("errorifexists").json(f"{target}/manifest/version={number:06d}-{uuid.uuid4().hex[:8]}")
    same = _versions(spark, target).where(F.col("version").startswith(f"{number:06d}-")).select("version").distinct().count()
    if same != 1:
        raise RuntimeError(f"two writers committed version {number} of {target}")


def _on_disk(spark: SparkSession, folders: Mapping[int, str]) -> dict[int, tuple[int, int]]:
    """Number and bytes of the data files of each year's load, by one job; a missing folder has none."""

    def listing(year: int, folder: str) -> DataFrame | None:
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        return files.select(F.lit(year).alias("year"), "length")

    found = [x for x in (listing(y, f) for y, f in folders.items()) if x is not None]
    rows = reduce(DataFrame.unionByName, found).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes")).collect() if found else []
    return {y: (0, 0) for y in folders} | {r["year"]: (r["n"], r["bytes"]) for r in rows}


def _whole(spark: SparkSession, target: str, entries: Mapping[int, Entry]) -> set[int]:
    """The years whose data files are those that were written."""
    disk = _on_disk(spark, {y: e.folder(target) for y, e in entries.items()})
    return {y for y, e in entries.items() if disk[y] == (e.data_files, e.data_bytes)}


def _load(spark: SparkSession, target: str, year: int, parts: Sequence[Part], types: Mapping, columns: str, files: DataFrame) -> Entry:
    """Write one year; the entry has yet to be committed."""
    load = uuid.uuid4().hex[:16]
    watched = [Observation() for _ in parts]
    rows = year_of(spark, parts, year, columns, types, broken=True, watched=watched)
    entry = Entry(year, load, "", "", rows.drop(YEAR_COL).schema.json(), 0, 0, 0, 0, "")
    folder = entry.folder(target)
    flagged = rows.withColumns({IN_YEAR_COL: issued_in_file_year(), BROKEN: F.col(BROKEN_COL).isNotNull()})
    (
        indexed(ordered(flagged.drop(YEAR_COL), [BROKEN, IN_YEAR_COL]).write)
        .mode("errorifexists")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(BROKEN, IN_YEAR_COL)
        .parquet(folder)
    )
    files.write.mode("errorifexists").parquet(f"{target}/sources/load={load}/{YEAR_COL}={year}")
    counts: dict[str, int] = defaultdict(int)
    for o in watched:
        for name, n in o.get.items():
            counts[name] += n
    n, size = _on_disk(spark, {year: folder})[year]
    return replace(
        entry, data_files=n, data_bytes=size, rows=counts.pop("rows", 0), broken=counts.pop("broken", 0),
        unreadable=json.dumps({c: k for c, k in sorted(counts.items()) if k}),
    )


def at_once(work: Callable, years: Iterable[int]) -> dict:
    """``work`` on several years at a time: each is a job or more of its own."""
    years = sorted(years)
    if not years:
        return {}
    with ThreadPoolExecutor(min(YEARS_AT_ONCE, len(years))) as pool:
        return dict(zip(years, pool.map(work, years), strict=True))


def _inferred_of(entry: Entry) -> dict[str, T.DataType | None]:
    return {n: T.DataType.fromDDL(t) if t else None for n, t in json.loads(entry.inferred).items()}


def store_years(
    spark: SparkSession,
    paths: Mapping[int, str | Sequence[str]],
    target: str | None = None,
    columns: str = "used",
    infer_schema: bool = False,
    broken: str = "keep",
    content: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Bring the table at ``target`` up to date with ``paths``; ``(all rows, clean rows)`` of the years of ``paths``.

    Without ``target`` the table is this application's, one for each choice of arguments.
    Years of the table that ``paths`` doesn't name stay in it. A year is written again if
    its files changed, if it was stored with other ``columns`` or ``infer_schema``, if a new
    part makes one of its columns wider, or if its data files are damaged.
    """
    if target is None:
        target = own_folder(spark, f"csv:{columns}:{infer_schema}:{content}:{sorted(paths.items())}")
    target = target.rstrip("/")
    with _LOCKS[target]:
        # An empty version first: a table that is new is then read like any other.
        spark.createDataFrame([], ENTRY_SCHEMA).write.mode("ignore").json(f"{target}/manifest/version=000000-start")
        number, entries = _latest(spark, target)
        given = {year: [path] if isinstance(path, str) else list(path) for year, path in sorted(paths.items())}

        marks = _fingerprints(spark, given, f"{columns}|{infer_schema}|{content}", content)
        same = {y: entries[y] for y in given if y in entries and entries[y].fingerprint == marks.get(y)}
        whole = _whole(spark, target, same)
        # A year without any file has no fingerprint; it is loaded each time.
        new = {year: marks.get(year, "") for year in given if year not in whole}
        parts = at_once(lambda year: parts_of(spark, given[year]), new)
        infers = infer_schema and columns == "all"
        found = {year: _inferred_of(entries[year]) for year in given if year not in new}
        found |= at_once(lambda year: inferred(spark, parts[year]) if infers else {}, new)
        types = stated(found.values())
        for year in given:
            if year not in new and not _fits(entries[year], found[year], types):
                parts[year], new[year] = parts_of(spark, given[year]), entries[year].fingerprint

        def load(year: int) -> Entry:
            told = json.dumps({n: t.simpleString() if t else None for n, t in found[year].items()})
            entry = _load(spark, target, year, parts[year], types, columns, listed(spark, given[year], content))
            return replace(entry, fingerprint=new[year], inferred=told)

        if new:
            entries |= at_once(load, new)
            _commit(spark, target, number + 1, entries)
        return _views(spark, target, [entries[y] for y in sorted(paths)], broken)


def _fits(entry: Entry, found: Mapping[str, T.DataType | None], types: Mapping[str, T.DataType | None]) -> bool:
    """Whether a year was stored with the types that are stated now."""
    fields = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(entry.columns))}
    return all(fields[build_name(c)] == (types[c] or T.StringType()) for c in found)


def entries_of(spark: SparkSession, target: str) -> dict[int, Entry]:
    """The years of a table's last version."""
    return dict(sorted(_latest(spark, target.rstrip("/"))[1].items()))


def open_years(spark: SparkSession, target: str, broken: str = "keep") -> tuple[DataFrame, DataFrame]:
    """``(all rows, clean rows)`` of all years of a table, without its source files."""
    target = target.rstrip("/")
    _, entries = _latest(spark, target)
    if not entries:
        raise DamagedTable(f"no committed table at {target}")
    if damaged := sorted(set(entries) - _whole(spark, target, entries)):
        raise DamagedTable(f"{target}: data files of {damaged} are missing or cut; store these years again")
    return _views(spark, target, [e for _, e in sorted(entries.items())], broken)


def scan_of(spark: SparkSession, target: str, entries: Sequence[Entry]) -> DataFrame:
    """Rows of several loads: one scan for all that were written with the same columns."""
    by_columns: dict[str, list[Entry]] = {}
    for e in entries:
        by_columns.setdefault(e.columns, []).append(e)
    folders = T.StructType(
        [
            T.StructField(YEAR_COL, T.IntegerType()),
            T.StructField(BROKEN, T.BooleanType()),
            T.StructField(IN_YEAR_COL, T.BooleanType()),
            T.StructField("load", T.StringType()),
        ]
    )
    out = None
    for columns, same in by_columns.items():
        schema = T.StructType([*T.StructType.fromJson(json.loads(columns)), *folders])
        scan = spark.read.schema(schema).option("basePath", f"{target}/data").parquet(*(e.folder(target) for e in same)).drop("load")
        out = scan if out is None else out.unionByName(scan, allowMissingColumns=True)
    return out


def _views(spark: SparkSession, target: str, entries: Sequence[Entry], broken: str) -> tuple[DataFrame, DataFrame]:
    if broken not in ("keep", "quarantine"):
        raise ValueError(f"broken must be 'keep' or 'quarantine', not {broken!r}")
    if not entries:
        raise ValueError("no years to store")
    rows = scan_of(spark, target, entries)
    if broken == "quarantine":
        rows = rows.where(~F.col(BROKEN))
    names = [c for c in rows.columns if c not in (BROKEN_COL, SOURCE_COL, BROKEN, IN_YEAR_COL)]
    names = list(TICKET_COLUMNS) if set(names) == set(TICKET_COLUMNS) else [*(c for c in names if c != YEAR_COL), YEAR_COL]
    return rows.select(*names), rows.where(F.col(IN_YEAR_COL)).select(*names)


def broken_records(spark: SparkSession, target: str) -> DataFrame:
    """The quarantine: ``file_year``, ``source_file``, ``reason`` and ``record`` (the line as it stands) of all years."""
    target = target.rstrip("/")
    rows = scan_of(spark, target, list(_latest(spark, target)[1].values())).where(F.col(BROKEN))
    return rows.select(YEAR_COL, F.col(SOURCE_COL).alias("source_file"), F.col(f"{BROKEN_COL}.reason"), F.col(f"{BROKEN_COL}.record"))


def load_report(spark: SparkSession, target: str) -> DataFrame:
    """What the last load of each year counted: ``file_year``, ``rows``, ``broken``, ``unreadable`` (cells by column)."""
    _, entries = _latest(spark, target.rstrip("/"))
    rows = [(e.file_year, e.rows, e.broken, json.loads(e.unreadable)) for _, e in sorted(entries.items())]
    return spark.createDataFrame(rows, f"{YEAR_COL} int, rows long, broken long, unreadable map<string,long>")

"""Yearly citation CSV files -> one conformed citation table.

* ``read_year_csv`` reads one fiscal year with its header: a file, a folder of
  parts that share a header, or a list of parts with headers of their own. Parts of a folder
  whose headers differ are an error, never columns in the wrong place. Without ``infer_schema`` no pass over the data is made to plan it:
  every column is text, and only the columns the analyses use are selected
  and typed (``try_cast``: a malformed number becomes NULL instead of failing
  the job). Spark's CSV reader then parses only those columns.
* With ``infer_schema`` the carried columns get types, too: each part's are inferred, a column's
  stated type is the least that holds its types in all parts of all years
  (``sources.types``), and every part is read with the stated types.
* Columns are matched **by name**, so files whose columns differ in number
  or order (51 against 43 columns) conform to the same schema; the reference
  dropped the surplus columns by position.
* A record with too many or too few cells is read as far as it goes, as the
  reference does; ``year_of(broken=True)`` says which these are and what they look like
  (``sources.yearly`` stores them).
* ``union_years`` binds conformed years with ``unionByName`` (UNION ALL,
  duplicates kept); ``schema_drift`` lists the columns not shared by all
  files; ``register_views`` names frames for SQL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameReader, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import EXTRA_COLUMNS, TICKET_FIELDS, USED_COLUMNS, YEAR_COL, build_name
from .types import stated

#: A broken record's reason and text, and its file; NULL for all other rows.
BROKEN_COL, SOURCE_COL = "broken_record", "source_file"
_RECORD = "_broken_record_text"
#: Headers that are read at the same time.
HEADERS_AT_ONCE = 8

Types = Mapping[str, T.DataType | None]


@dataclass(frozen=True)
class Part:
    """Files, or folders of files, that share a header."""

    header: tuple[str, ...]
    paths: tuple[str, ...]


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _reader(spark: SparkSession) -> DataFrameReader:
    # enforceSchema=False: each file's header is checked against the columns
    # it is read with, and a file with other columns, or in another order, fails the job.
    return spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)


def _paths(path: str | Sequence[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def parts_of(spark: SparkSession, path: str | Sequence[str]) -> list[Part]:
    """The paths of a year grouped by header. Headers are read several at a time, each by a job on one line."""
    paths = _paths(path)
    if not paths:
        raise ValueError("no parts for a year")
    with ThreadPoolExecutor(min(HEADERS_AT_ONCE, len(paths))) as pool:
        headers = list(pool.map(lambda p: tuple(spark.read.option("header", True).csv(p).columns), paths))
    same: dict[tuple[str, ...], list[str]] = {}
    for header, p in zip(headers, paths, strict=True):
        same.setdefault(header, []).append(p)
    return [Part(header, tuple(of)) for header, of in same.items()]


def inferred(spark: SparkSession, parts: Sequence[Part]) -> dict[str, T.DataType | None]:
    """The types of the carried columns over several parts; None where no part has a value.

    Two passes over the files: Spark's inference, and a count that tells a column of
    text from one without any value.
    """
    found = []
    for part in parts:
        read = _reader(spark).option("inferSchema", True).csv(list(part.paths))
        types = {f.name: f.dataType for f in read.schema if f.name not in USED_COLUMNS and f.name not in EXTRA_COLUMNS}
        text = [c for c, t in types.items() if isinstance(t, T.StringType)]
        if text:
            counts = read.agg(*(F.count(F.col(_quote(c))).alias(str(i)) for i, c in enumerate(text))).first()
            types |= {c: None for c, n in zip(text, counts, strict=True) if not n}
        found.append(types)
    return stated(found)


def _raw(spark: SparkSession, part: Part, types: Types, broken: bool) -> DataFrame:
    """The columns of a part as they stand, the used ones as text; broken records marked if asked for."""
    kinds = {c: T.StringType() if c in USED_COLUMNS else types.get(c) or T.StringType() for c in part.header}
    schema = T.StructType([T.StructField(c, t) for c, t in kinds.items()])
    if not broken:
        return _reader(spark).schema(schema).csv(list(part.paths))
    # Cells are counted only where a record is parsed whole.
    reader = _reader(spark).option("columnPruning", False).option("columnNameOfCorruptRecord", _RECORD)
    raw = reader.schema(schema.add(_RECORD, T.StringType())).csv(list(part.paths))
    bare = F.regexp_replace(_RECORD, '"(?:[^"\\\\]|\\\\.)*"', "")
    cells = F.size(F.split(bare, ","))
    reason = (
        F.when(F.contains(bare, F.lit('"')), F.lit("open quote"))
        .when(cells > len(part.header), F.lit("too long"))
        .when(cells < len(part.header), F.lit("too short"))
        .otherwise(F.lit("unreadable cell"))
    )
    wrong = F.col(_RECORD).isNotNull()
    return raw.withColumns(
        {
            BROKEN_COL: F.when(wrong, F.struct(reason.alias("reason"), F.col(_RECORD).alias("record"))),
            SOURCE_COL: F.when(wrong, F.col("_metadata.file_path")),
        }
    ).drop(_RECORD)


def _lost_cells() -> dict[str, Column]:
    """By typed column, the number of cells that hold text but no value of its type."""
    typed = {src: (name, t) for src, (name, t) in USED_COLUMNS.items() if t.simpleString() != "string"}
    return {
        name: F.count_if(F.col(_quote(src)).isNotNull() & F.col(_quote(src)).try_cast(t).isNull()) for src, (name, t) in typed.items()
    }


def year_of(
    spark: SparkSession,
    parts: Sequence[Part],
    file_year: int,
    columns: str = "used",
    types: Types = {},
    broken: bool = False,
    watched: Sequence[Observation] = (),
) -> DataFrame:
    """One year's parts, conformed and bound by name.

    ``broken`` adds ``BROKEN_COL`` and ``SOURCE_COL``. ``watched`` (one for each part) observes what
    passes: ``rows``, ``broken`` and the unreadable cells by column.
    """
    frames = []
    for i, part in enumerate(parts):
        raw = _raw(spark, part, types, broken)
        if watched:
            counts = [F.count(F.lit(1)).alias("rows"), F.count_if(F.col(BROKEN_COL).isNotNull()).alias("broken")]
            raw = raw.observe(watched[i], *counts, *(c.alias(name) for name, c in _lost_cells().items()))
        frames.append(conform(raw, file_year, columns=columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=columns == "all"), frames)


def read_year_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    file_year: int,
    columns: str = "used",
    infer_schema: bool = False,
) -> DataFrame:
    """One fiscal year of CSV (header row, empty cell = NULL), conformed.

    A list of paths is read part by part: parts with one header together, and
    all bound by name, so their columns may differ in order and number.
    """
    return read_years(spark, {file_year: path}, columns, infer_schema)


def unreadable(raw: DataFrame, file_year: int) -> DataFrame:
    """What typing loses: cells per typed column that hold text but no value of its type.

    ``raw`` has the file's own columns as text. ``column_name, file_year, n``,
    zero counts absent; one scan of the typed columns.
    """
    lost = _lost_cells()
    return (
        raw.agg(*(c.alias(name) for name, c in lost.items()))
        .unpivot([], list(lost), "column_name", "n")
        .where(F.col("n") > 0)
        .select("column_name", F.lit(int(file_year)).cast("int").alias(YEAR_COL), "n")
    )


def conform(raw: DataFrame, file_year: int, columns: str = "used") -> DataFrame:
    """Rename source columns to build names, type them and tag ``file_year``.

    ``columns="used"``: the narrow citation table (the 11 named columns plus
    ``file_year``, in build order). ``columns="all"``: every column but the
    surplus ones of ``EXTRA_COLUMNS``, the used ones typed, the rest as read.
    """
    present = raw.columns
    missing = [c for c in USED_COLUMNS if c not in present]
    if missing:
        raise ValueError(f"file for {file_year} lacks columns {missing}")
    by_build = {name: (src, dtype) for src, (name, dtype) in USED_COLUMNS.items()}
    year = F.lit(int(file_year)).cast("int").alias(YEAR_COL)
    marks = [c for c in (BROKEN_COL, SOURCE_COL) if c in present]

    def typed(src: str, dtype) -> F.Column:
        col = F.col(_quote(src))
        if dict(raw.dtypes)[src] != dtype.simpleString():
            col = col.try_cast(dtype)
        return col.alias(USED_COLUMNS[src][0])

    if columns == "used":
        out = []
        for name, _ in TICKET_FIELDS:
            if name == YEAR_COL:
                out.append(year)
            else:
                src, dtype = by_build[name]
                out.append(typed(src, dtype))
        return raw.select(*out, *marks)
    if columns == "all":
        out = []
        for src in present:
            if src in EXTRA_COLUMNS or src in marks:
                continue
            if src in USED_COLUMNS:
                out.append(typed(src, USED_COLUMNS[src][1]))
            else:
                out.append(F.col(_quote(src)).alias(build_name(src)))
        return raw.select(*out, year, *marks)
    raise ValueError(f"columns must be 'used' or 'all', not {columns!r}")


def union_years(frames: Iterable[DataFrame], missing: bool = False) -> DataFrame:
    """Row bind of conformed years (UNION ALL by column name); ``missing`` fills columns that a year lacks with NULL."""
    frames = list(frames)
    if not frames:
        raise ValueError("no frames to bind")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def read_years(
    spark: SparkSession,
    paths: Mapping[int, str | Sequence[str]],
    columns: str = "used",
    infer_schema: bool = False,
) -> DataFrame:
    """Master citation table of several fiscal years: ``{year: path or list of parts}``.

    Inferred types are stated over all years; only ``columns="all"`` has columns to infer.
    """
    parts = {year: parts_of(spark, path) for year, path in sorted(paths.items())}
    types = stated(inferred(spark, p) for p in parts.values()) if infer_schema and columns == "all" else {}
    return union_years((year_of(spark, p, year, columns, types) for year, p in parts.items()), missing=columns == "all")


def schema_drift(frames: Mapping[int, DataFrame]) -> DataFrame:
    """Columns not present in every frame: ``column_name, n_files``.

    Reads schemas only (no job). The result is built from column names, a
    list bounded by the files' width.
    """
    if not frames:
        raise ValueError("no frames to compare")
    spark = next(iter(frames.values())).sparkSession
    counts: dict[str, int] = {}
    order: list[str] = []
    for df in frames.values():
        for c in df.columns:
            if c not in counts:
                order.append(c)
            counts[c] = counts.get(c, 0) + 1
    rows = [(c, counts[c]) for c in order if counts[c] < len(frames)]
    return spark.createDataFrame(rows, "column_name string, n_files int")


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """``createOrReplaceTempView`` for each ``{name: frame}``."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)

"""Grouped counts, per-group top-k, ranked lists and histograms.

Scale notes
-----------
* Every count is a two-phase HashAggregate: rows are combined per map task
  before the shuffle, so a key holding a third of all rows costs one partial
  row per task, not a third of the shuffle.
* Top-k and ranks run on the aggregated counts, never on raw rows. The
  ``rk <= k`` filter sits right above the window so Catalyst plans a partial
  ``WindowGroupLimit`` before the exchange and a final one after it: at most
  k rows (plus ties for dense rank) per group leave each map task.
* Histograms never collect to the driver. Bins are counted with Spark
  aggregates; empty bins come as rows of weight zero from a generated
  ``sequence`` (no cross join).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import YEAR_COL


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def counts_by(
    df: DataFrame,
    keys: str | Sequence[str],
    counted: str | None = None,
    name: str = "n",
) -> DataFrame:
    """``groupBy(keys).agg(count(counted))``; ``counted=None`` counts rows.

    ``count(col)`` skips NULLs, so a NULL key counted on itself is a group
    with count 0, as in SQL.
    """
    target: Column = F.lit(1) if counted is None else F.col(counted)
    return df.groupBy(*_cols(keys)).agg(F.count(target).alias(name))


def exact_sum(column: str) -> Column:
    """Sum of whole numbers in decimals: numbers of thirteen digits exceed a bigint in some millions of rows."""
    return F.sum(F.col(column).cast("decimal(20,0)")).cast("decimal(38,0)")


def fitted(rows: DataFrame, column: str) -> DataFrame:
    """``rows`` with an ``exact_sum`` as bigint, or, if one of them is beyond that, as the decimal that it is.

    Asks for the sums, so ``rows`` is worked out once more.
    """
    fits = F.col(column).try_cast("bigint").isNotNull() | F.col(column).isNull()
    return rows.withColumn(column, F.col(column).cast("bigint")) if rows.where(~fits).isEmpty() else rows


def top_k_per(
    counts: DataFrame,
    group: str | Sequence[str],
    order_col: str,
    k: int,
    tie_keys: str | Sequence[str] = (),
    rank_name: str = "rk",
) -> DataFrame:
    """First ``k`` rows of each group by ``order_col`` descending.

    Ties are broken by ``tie_keys`` ascending with NULLs last, so the cut is
    deterministic (and identical on a recomputed partition).
    """
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in _cols(tie_keys)]
    w = Window.partitionBy(*_cols(group)).orderBy(*order)
    return counts.withColumn(rank_name, F.row_number().over(w)).where(F.col(rank_name) <= k)


def ranked_within(
    counts: DataFrame,
    group: str | Sequence[str],
    order_col: str,
    k: int,
    rank_name: str = "rk",
) -> DataFrame:
    """Rows whose dense rank by ``order_col`` (descending) is at most ``k``.

    Ties share a rank and are all kept, so a group can give more than k rows.
    """
    w = Window.partitionBy(*_cols(group)).orderBy(F.col(order_col).desc_nulls_last())
    return counts.withColumn(rank_name, F.dense_rank().over(w)).where(F.col(rank_name) <= k)


def within_top_groups(
    df: DataFrame,
    group: str | Sequence[str],
    key: str,
    weight: str,
    k: int,
) -> DataFrame:
    """Rows of ``df`` whose ``key`` is one of the ``k`` heaviest keys of its group.

    A key's weight is the sum of ``weight`` over its rows; keys are ranked by
    weight descending, then key ascending with NULLs last, and the first
    ``k`` kept. A NULL key takes a rank but is never kept, as with an
    equality filter on the chosen keys.

    This is the semi join "rows whose key is in the group's top k" done with
    two windows over ``df``: when ``df`` is a grouped count, the raw rows are
    scanned once and both windows run on the counts (a join to a derived
    key list would instead be pushed below the aggregate into a second scan).
    """
    g = _cols(group)
    total = F.sum(weight).over(Window.partitionBy(*g, key))
    order = Window.partitionBy(*g).orderBy(F.col("_key_total").desc_nulls_last(), F.col(key).asc_nulls_last())
    return (
        df.withColumn("_key_total", total)
        .withColumn("_key_rank", F.dense_rank().over(order))
        .where((F.col("_key_rank") <= k) & F.col(key).isNotNull())
        .drop("_key_total", "_key_rank")
    )


def _bin(x: Column, lo: Column, hi: Column, nbins: int, integral: bool) -> Column:
    """The bin of ``x``: right-closed, the least value in bin 0, all in bin 0 where ``lo = hi``."""
    if integral:
        # ceil(a / b) for a >= 0, b > 0 as (a + b - 1) div b: exact integers.
        a = (x.cast("bigint") - lo.cast("bigint")) * F.lit(nbins)
        b = F.nullif((hi - lo).cast("bigint"), F.lit(0))
        raw = F.call_function("div", a + b - 1, b)
    else:
        raw = F.ceil((x - lo).cast("double") * F.lit(float(nbins)) / F.nullif((hi - lo).cast("double"), F.lit(0.0)))
    # A double quotient may round to just above nbins for the largest values.
    return F.coalesce(F.least(F.greatest(raw - 1, F.lit(0)), F.lit(nbins - 1)), F.lit(0)).cast("int")


def _centroid(lo: Column, hi: Column, nbins: int) -> Column:
    """``lo + (bin + 0.5) * (hi - lo) / nbins``; one division keeps it correctly rounded."""
    twice = lo.cast("double") * F.lit(2 * nbins) + (F.col("bin") * 2 + 1).cast("double") * (hi - lo).cast("double")
    return twice / F.lit(float(2 * nbins))


def _is_integral(df: DataFrame, col: str) -> bool:
    return dict(df.dtypes)[col] in ("tinyint", "smallint", "int", "bigint")


def histogram(
    df: DataFrame,
    col: str,
    nbins: int = 12,
    by: str | Sequence[str] = YEAR_COL,
    discrete: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """Equi-width histogram of ``col`` per ``by``: ``[by, bin, centroid, n]``.

    Bins are right-closed and the minimum falls in bin 0:
    ``bin = max(ceil((x - min) * nbins / (max - min)) - 1, 0)``, computed in
    exact integer arithmetic for integral columns. If ``max = min`` every row
    is in bin 0. NULLs are left out. All ``nbins`` bins are returned, empty
    ones with ``n = 0``. ``centroid = min + (bin + 0.5) * (max - min) / nbins``.

    ``discrete=True`` suits codes and precincts (few distinct values): rows
    are first counted per (by, value), so the rows are scanned once;
    ``weight`` names a column of such counts that are there already.
    ``discrete=False`` suits continuous columns, where such a count would have
    as many rows as the data: rows are scanned twice instead. The answer is
    the same. Min and max are a two-phase aggregate, one row per group, and
    meet the values again by a null-safe join that AQE broadcasts by measured
    size; no task holds the values of a whole group.

    Every group's bins come as rows of weight zero beside the binned values, so the
    aggregate that counts the bins fills the empty ones, too.
    """
    if nbins < 1:
        raise ValueError("nbins must be at least 1")
    by = _cols(by)
    integral = _is_integral(df, col)
    present = df.where(F.col(col).isNotNull())
    if weight is not None:
        weighted = present.select(*by, F.col(col).alias("_x"), F.col(weight).cast("bigint").alias("_w"))
    elif discrete:
        weighted = present.select(*by, F.col(col).alias("_x")).groupBy(*by, "_x").agg(F.count(F.lit(1)).alias("_w"))
    else:
        weighted = present.select(*by, F.col(col).alias("_x"), F.lit(1).cast("bigint").alias("_w"))
    groups = {c: f"_by_{i}" for i, c in enumerate(by)}
    stats = (
        weighted.groupBy(*by)
        .agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.sum("_w").alias("_all"))
        # Uses the counts, so that Catalyst shares them instead of scanning for min and max.
        .where("_all > 0")
        .drop("_all")
    )
    same = [F.col(c).eqNullSafe(F.col(g)) for c, g in groups.items()]
    in_bins = weighted.join(stats.withColumnsRenamed(groups), reduce(Column.__and__, same)).select(
        *by, "_lo", "_hi", _bin(F.col("_x"), F.col("_lo"), F.col("_hi"), nbins, integral).alias("bin"), "_w"
    )
    zeros = stats.select(
        *by, "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(nbins - 1))).alias("bin"), F.lit(0).cast("bigint").alias("_w")
    )
    return (
        in_bins.unionByName(zeros)
        .groupBy(*by, "_lo", "_hi", "bin")
        .agg(F.sum("_w").cast("bigint").alias("n"))
        .select(*by, "bin", _centroid(F.col("_lo"), F.col("_hi"), nbins).alias("centroid"), "n")
        .orderBy(*by, "bin")
    )


def binned(
    per_value: DataFrame, col: str, weight: str, ranges: Mapping[object, tuple[int, int]], nbins: int = 12, by: str = YEAR_COL
) -> DataFrame:
    """``histogram`` of counts per value where each group's least and largest value is known beforehand.

    ``ranges`` has an entry per group, as many as the listing of a table has folders. The values need no look at
    their own minimum first, so one shuffle counts the bins; the empty ones come from a
    local list of ``ranges`` times ``nbins`` rows.
    """
    if nbins < 1:
        raise ValueError("nbins must be at least 1")
    spark, kind = per_value.sparkSession, per_value.schema[by].dataType.simpleString()
    known = [(g, int(lo), int(hi), b, 0) for g, (lo, hi) in sorted(ranges.items()) if lo is not None for b in range(nbins)]
    zeros = spark.createDataFrame(known, f"`{by}` {kind}, _lo long, _hi long, bin int, _w long")
    if not known:
        return zeros.select(by, "bin", F.lit(0.0).alias("centroid"), F.col("_w").alias("n"))
    bounds = F.create_map(*(x for g, lo, hi, b, _ in known if not b for x in (F.lit(g).cast(kind), F.struct(F.lit(lo).cast("long").alias("lo"), F.lit(hi).cast("long").alias("hi")))))
    mine = F.element_at(bounds, F.col(by))
    values = per_value.where(F.col(col).isNotNull()).select(by, mine["lo"].alias("_lo"), mine["hi"].alias("_hi"), F.col(col).alias("_x"), F.col(weight).alias("_w"))
    in_bins = values.select(by, "_lo", "_hi", _bin(F.col("_x"), F.col("_lo"), F.col("_hi"), nbins, True).alias("bin"), "_w")
    return (
        in_bins.unionByName(zeros)
        .groupBy(by, "_lo", "_hi", "bin")
        .agg(F.sum("_w").cast("bigint").alias("n"))
        .select(by, "bin", _centroid(F.col("_lo"), F.col("_hi"), nbins).alias("centroid"), "n")
        .orderBy(by, "bin")
    )


def histograms(
    df: DataFrame,
    cols: Sequence[str],
    nbins: int = 12,
    by: str | Sequence[str] = YEAR_COL,
) -> DataFrame:
    """Histograms of several columns of one type in one scan:
    ``[column_name, *by, bin, centroid, n]``.

    The columns become ``(column_name, value)`` rows and are binned with
    ``column_name`` as one more group key, so the table is read once for all
    of them (the reference cached a projection and binned it three times).
    """
    keys = _cols(by)
    # inline, not unpivot: Spark shares the counts' shuffle between the two
    # sides of the histogram's join only above an operator that it can compare.
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_value")) for c in cols))
    long = df.select(*keys, F.inline(pairs))
    return histogram(long, "_value", nbins=nbins, by=["column_name", *keys], discrete=True)

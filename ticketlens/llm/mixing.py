"""Mixing sources to target weights by a Pfair schedule; native expressions only.

Each source's documents, in an order that looks random, are cut into blocks.
A source of weight ``w`` has its block ``i`` (from 0) released at slot
``floor(i / w)`` and due by slot ``ceil((i + 1) / w)``; each slot goes to the
released block with the earliest deadline. As the weights add up to one, all
deadlines are met, so at every slot each source has had its weight's share of
blocks to within less than one block.

Weights are whole numbers of slots in a period, so the schedule of one period
repeats. It is worked out once, in one row of as many entries as the period
has slots, and joined to blocks by their number modulo the source's slots of a period: the
only table that is broadcast has ``period`` rows whatever the input. A source that runs
out leaves its slots empty; no document is dropped or repeated.

A source may hold most rows, so ranks within a source are taken in buckets of
the order key: counts per bucket, summed over earlier buckets, plus the rank
within the bucket. Positions in the whole mix add block sizes the same way.

Defined cases: a null source is the source ``''``; documents with the same id
are ordered by their other columns; target weights of sources that are absent
have no effect, sources without a target weight get one slot of a period; an
empty table gives an empty mix; extra columns are kept, but ``scheduled`` and
``positions`` replace those that have the name of a column they add.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Documents of a block; slots of a period (more if there are many sources).
BLOCK_ROWS = 64
PERIOD = 1024
#: Default target weights are the sources' sizes to this power.
EXPONENT = 0.5
BUCKET_ROWS = 4096
CHUNK_SLOTS = 4096
ADDED = ("block", "release", "deadline", "slot", "in_block")


def _source() -> Column:
    return F.coalesce(F.col("source").cast("string"), F.lit(""))


def source_slots(
    docs: DataFrame, weights: Mapping[str, float] | None = None, exponent: float = EXPONENT, period: int = PERIOD
) -> DataFrame:
    """``source``, its ``rows``, its number ``j`` and its ``slots`` in a ``period``.

    Every source has one slot; the rest go by weight, whole parts first and
    then one each to the largest remainders.
    """
    sizes = docs.groupBy(_source().alias("source")).agg(F.count("*").alias("rows"))
    if weights:
        known = F.create_map(*(F.lit(x) for pair in weights.items() for x in pair))
        weight = F.coalesce(F.try_element_at(known, F.col("source")), F.lit(0.0)).cast("double")
    else:
        weight = F.pow(F.col("rows").cast("double"), F.lit(float(exponent)))
    every = Window.partitionBy()  # one row per source
    quota = (
        sizes.withColumn("weight", weight)
        .withColumns({"sources": F.count("*").over(every), "total": F.sum("weight").over(every)})
        .withColumn("period", F.greatest(F.lit(period), 64 * F.col("sources")).cast("long"))
        .withColumn(
            "share",
            F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(1.0 / F.col("sources"))
            * (F.col("period") - F.col("sources")),
        )
        .withColumn("part", F.floor("share"))
    )
    spare = F.col("period") - F.col("sources") - F.sum("part").over(every)
    place = F.row_number().over(Window.orderBy((F.col("share") - F.col("part")).desc(), "source"))
    return quota.select(
        "source",
        "rows",
        (F.row_number().over(Window.orderBy("source")) - 1).alias("j"),
        (1 + F.col("part") + F.when(place <= spare, 1).otherwise(0)).cast("long").alias("slots"),
        "period",
    )


def one_period(slots: DataFrame) -> DataFrame:
    """The schedule of one period: a row per slot with its source, the
    number ``k`` of the block among the source's blocks of the period, and the
    block's release and deadline.
    """
    row = slots.groupBy("period").agg(
        F.array_sort(F.collect_list(F.struct("j", "source", "slots"))).alias("all")
    )
    # Earliest deadline first. State: blocks given to each source so far, and
    # the source of each slot so far.
    chosen = """
        aggregate(
            sequence(0L, period - 1),
            struct(transform(all, s -> 0L) AS given, CAST(array() AS array<int>) AS taken),
            (state, t) -> transform(
                array(
                    array_min(transform(
                        filter(all, s -> state.given[s.j] < s.slots AND (state.given[s.j] * period) div s.slots <= t),
                        s -> struct(((state.given[s.j] + 1) * period + s.slots - 1) div s.slots AS due, s.j AS j)
                    )).j
                ),
                j -> struct(
                    transform(state.given, (n, i) -> n + IF(i = j, 1L, 0L)) AS given,
                    concat(state.taken, array(j)) AS taken
                )
            )[0],
            state -> state.taken
        )
    """
    return (
        row.select("all", "period", F.posexplode(F.expr(chosen)).alias("slot", "j"))
        .select("period", "slot", F.expr("all[j]").alias("s"))
        .select("period", "slot", "s.source", "s.slots")
        .withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("slot")).cast("long") - 1)
    )


def ranked(docs: DataFrame) -> DataFrame:
    """``docs`` with ``rank`` from 0 within the source, by a digest of the id."""
    buckets = max(1, -(-docs.count() // BUCKET_ROWS))
    names = docs.columns
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keyed = docs.withColumns({"_source": _source(), "_key": digest}).withColumn(
        "_bucket", F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("long") * buckets / F.lit(2**32))
    )
    counts = (
        keyed.groupBy("_source", "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn(
            "_before",
            F.coalesce(
                F.sum("_n").over(
                    Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .drop("_n")
    )
    plain = [f.name for f in docs.schema if isinstance(f.dataType, (T.NumericType, T.StringType)) and f.name != "doc_id"]
    within = Window.partitionBy("_source", "_bucket").orderBy("_key", "doc_id", *plain)
    return (
        keyed.join(counts, ["_source", "_bucket"])
        .withColumn("_rank", F.col("_before") + F.row_number().over(within) - 1)
        .select(*names, "_source", "_rank")
    )


def _scheduled(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    exponent: float = EXPONENT,
    period: int = PERIOD,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``docs`` with the schedule's columns, their names after an underscore."""
    names = docs.columns
    slots = source_slots(docs, weights, exponent, period)
    table = F.broadcast(one_period(slots)).withColumnsRenamed(
        {"source": "_source", "slot": "_at", "k": "_k", "slots": "_slots", "period": "_period"}
    )
    shares = F.broadcast(slots.select(F.col("source").alias("_source"), F.col("slots").alias("_per")))
    return (
        ranked(docs)
        .withColumns(
            {"_block": F.expr(f"_rank div {block_rows}"), "_in_block": F.expr(f"CAST(_rank % {block_rows} AS INT)")}
        )
        .join(shares, "_source")
        .withColumn("_k", F.expr("_block % _per"))
        .join(table, ["_source", "_k"])
        .select(
            *names,
            "_block",
            F.expr("(_block * _period) div _slots").alias("_release"),
            F.expr("((_block + 1) * _period + _slots - 1) div _slots").alias("_deadline"),
            F.expr("(_block div _slots) * _period + _at").alias("_slot"),
            "_in_block",
        )
    )


def scheduled(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with the ``block`` of its source, the block's ``release``,
    ``deadline`` and ``slot``, and the place ``in_block``."""
    return _scheduled(docs.drop(*ADDED), **how).withColumnsRenamed({"_" + c: c for c in ADDED})


def mixed(docs: DataFrame, **how) -> DataFrame:
    """``docs`` as they come in the mix, with their own columns."""
    return _scheduled(docs, **how).orderBy("_slot", "_in_block").select(*docs.columns)


def positions(docs: DataFrame, **how) -> DataFrame:
    """``scheduled`` with ``position``, the document's place in the whole mix from 0."""
    rows = scheduled(docs.drop("position"), **how)
    sizes = rows.groupBy("slot").agg(F.count("*").alias("_n")).withColumn("_chunk", F.expr(f"slot div {CHUNK_SLOTS}"))
    earlier = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (
        sizes.groupBy("_chunk")
        .agg(F.sum("_n").alias("_of"))
        .select("_chunk", F.coalesce(F.sum("_of").over(earlier), F.lit(0)).alias("_ahead"))
    )
    inside = Window.partitionBy("_chunk").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.join(chunks, "_chunk").select(
        "slot", (F.col("_ahead") + F.coalesce(F.sum("_n").over(inside), F.lit(0))).alias("_first")
    )
    return rows.join(first, "slot").select(
        *rows.columns, (F.col("_first") + F.col("in_block")).alias("position")
    )

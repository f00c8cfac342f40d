"""Cumulative-snapshot collapse of logged conversations, then rendering; native expressions only.

A service that logs a conversation after every turn leaves many logs that
are prefixes of one another. A conversation's turn ``i`` has the hash
``h(i, role, text)``; the hash of its first ``k`` turns is the exclusive or of
the first ``k`` turn hashes, so it rolls along the turns and, as it may be
computed from parts in any order, a conversation of any length is worked on
in blocks. Two independent 64-bit hashes make a key of 128 bits.

A conversation is maximal if no longer one has its key among its prefixes:
an anti join of the conversations' keys against the distinct prefix keys.
Both sides are aggregated before they are shuffled (map side first), so a
first turn or a conversation that a third of all logs share is one row per
task. Of identical conversations the smallest id stays.

Rendered texts come in chunks of at most ``CHUNK`` turns, so that no row and
no task holds an unbounded conversation.

Defined cases: turns are ordered by (turn, role, text), nulls first, and
every row is a turn, repeated rows too; a null role or text counts as the
empty string, in the keys too; rows with a null ``conv_id`` form one
conversation; the marker ``<|`` inside a text is written ``< |``; an empty table gives no row.
Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import written

#: Turn numbers that one block spans, and turns of one rendered chunk.
BLOCK = 256
CHUNK = 64
_FIRST = -(1 << 62)


#: A conversation's key without NULLs, so that joins and windows by it share one shuffle.
KEY = ("k", "no_id")


def _turns(conversations: DataFrame) -> DataFrame:
    conv = F.col("conv_id").cast("long")
    return conversations.select(
        F.coalesce(conv, F.lit(0)).alias("k"),
        conv.isNull().alias("no_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        # Turns without a number come first, so does their block.
        F.coalesce(F.floor(F.col("turn").cast("long") / BLOCK), F.lit(_FIRST)).alias("block"),
    )


def _xor(name: str) -> Column:
    return F.bit_xor(name)


def prefix_keys(turns: DataFrame) -> DataFrame:
    """Each turn with its place ``i`` (from 1), the length ``n`` of its
    conversation, and the keys ``a`` and ``b`` of the prefix that it ends.

    Turns are shuffled once, by conversation and block; windows run within a block, and
    what earlier blocks add comes from a table with a row per block.
    """
    key = [*KEY, "block"]
    inside = Window.partitionBy(*key).orderBy("turn", "role", "text")
    # By the place, which no two rows share: tied turns roll in the order that numbered them.
    running = Window.partitionBy(*key).orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*KEY).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*KEY)

    placed = turns.withColumn("at", F.row_number().over(inside))
    counts = (
        turns.groupBy(*key)
        .agg(F.count("*").alias("rows"))
        .select(
            *key, F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"), F.sum("rows").over(whole).alias("n")
        )
    )
    numbered = placed.join(counts, key).withColumn("i", F.col("before") + F.col("at")).drop("before", "at")
    hashed = numbered.withColumns(
        {
            "h1": F.xxhash64("i", "role", "text"),
            "h2": F.xxhash64(F.lit("second"), "text", "role", "i"),
        }
    )
    rolled = hashed.withColumns({"x1": _xor("h1").over(running), "x2": _xor("h2").over(running)})
    totals = (
        hashed.groupBy(*key)
        .agg(_xor("h1").alias("t1"), _xor("h2").alias("t2"))
        .select(
            *key,
            F.coalesce(_xor("t1").over(earlier), F.lit(0)).alias("e1"),
            F.coalesce(_xor("t2").over(earlier), F.lit(0)).alias("e2"),
        )
    )
    return rolled.join(totals, key).select(
        *KEY, "role", "text", "i", "n",
        F.col("x1").bitwiseXOR(F.col("e1")).alias("a"),
        F.col("x2").bitwiseXOR(F.col("e2")).alias("b"),
    )


def maximal(keys: DataFrame) -> DataFrame:
    """Conversations that are no proper prefix of another: their ``KEY``, ``n``, ``n_copies``."""
    # A conversation without an id has the greatest one: it stands for its copies only if none has an id.
    own = F.struct("no_id", "k")
    whole = keys.where("i = n").groupBy("n", "a", "b").agg(F.min(own).alias("first"), F.count("*").alias("n_copies"))
    prefixes = keys.where("i < n").select(F.col("i").alias("n"), "a", "b").distinct()
    return whole.join(prefixes, ["n", "a", "b"], "left_anti").select("first.k", "first.no_id", "n", "n_copies")


def rendered_turn(role: Column, text: Column) -> Column:
    def safe(c: Column) -> Column:
        return F.replace(c, F.lit("<|"), F.lit("< |"))

    return F.concat(F.lit("<|"), safe(role), F.lit("|>\n"), safe(text), F.lit("\n<|end|>\n"))


def collapsed(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Maximal conversations, rendered: ``conv_id``, ``chunk`` (from 0),
    ``n_turns`` and ``n_copies`` of the conversation, ``rendered``."""
    # The keyed turns are written once and serve both sides.
    keyed = written(prefix_keys(_turns(conversations)), "keyed-turns")
    kept = maximal(keyed).drop("n")
    chunked = keyed.select(
        *KEY, "i", "n", ((F.col("i") - 1) / chunk).cast("int").alias("chunk"), rendered_turn(F.col("role"), F.col("text")).alias("part")
    )
    return (
        chunked.join(kept, [*KEY])
        .groupBy(*KEY, "chunk")
        .agg(
            F.first("n").cast("long").alias("n_turns"),
            F.first("n_copies").alias("n_copies"),
            F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "part"))), lambda x: x["part"]), "").alias("rendered"),
        )
        .select(F.when(~F.col("no_id"), F.col("k")).alias("conv_id"), "chunk", "n_turns", "n_copies", "rendered")
    )


ORACLE = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
        count(*) OVER (PARTITION BY conv_id) AS n
    FROM conversations
),
p AS (
    SELECT conv_id, i, n, md5(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (
        PARTITION BY conv_id ORDER BY i ROWS UNBOUNDED PRECEDING)) AS prefix
    FROM t
),
w AS (SELECT n, prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM p WHERE i = n GROUP BY n, prefix),
k AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.i < p.n AND p.i = w.n AND p.prefix = w.prefix))
SELECT t.conv_id, CAST((t.i - 1) // {CHUNK} AS INTEGER) AS chunk, max(t.n) AS n_turns, max(k.n_copies) AS n_copies,
    string_agg('<|' || replace(role, '<|', '< |') || '|>' || chr(10) || replace(text, '<|', '< |') || chr(10) || '<|end|>' || chr(10), '' ORDER BY t.i) AS rendered
FROM t JOIN k USING (conv_id) GROUP BY ALL
"""

"""Quality rules as a bitmask ledger; native expressions only.

Every rule is evaluated once: a ledger row holds what was measured of a
document and, in ``failed``, one bit for each rule that it fails. Policies
are versioned sets of rules, so a policy is a mask, and what it keeps is
``failed & mask = 0``. Changing a policy or asking what a rule costs needs no
text again: ``ablation`` counts, for each rule of a policy, the documents that
only this rule rejects, by bitwise operations on the ledger.

All work on a text stays in its row, on arrays of its words, lines and
windows; nothing is shuffled but the counts of ``ablation``.

Defined cases: a null text is empty and fails ``few_words``; an empty line has
no word and is no repeated line; repeated rows give equal ledger rows; null
ids are kept; an empty table gives an empty ledger; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values -----------------------------------------------------------
WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]+"
WINDOW = 3
# Rules in the order of their bits: name and the condition to fail.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 3 * n_words",
    "long_words": "word_chars > 12 * n_words",
    "few_letters": "10 * n_letter_words < 7 * n_words",
    "bare_lines": "n_lines > 20 AND n_words < 3 * n_lines",
}
# Versions of the policy: the rules that each applies.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words"),
    "v2": tuple(RULES),
}
# ---------------------------------------------------------------------------
PRODUCTION = "v2"


def mask(rules: Iterable[str]) -> int:
    """The rules' bits."""
    bit = {name: 1 << i for i, name in enumerate(RULES)}
    return sum({bit[r] for r in rules})


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and measurements of each whole text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("t")).select(
        "doc_id",
        F.array_remove(F.split("t", WORD_BREAK), "").alias("words"),
        F.filter(F.split("t", "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\f\r"))) > 0).alias("lines"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    windows = base.select(
        "doc_id",
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.rlike(w, F.lit(r"\p{L}")))).cast("long").alias("n_letter_words"),
        F.expr(
            f"IF(size(words) < {WINDOW}, array(), transform(slice(words, 1, size(words) - {WINDOW - 1}),"
            " (w, i) -> xxhash64(w, words[i + 1], words[i + 2])))"
        ).alias("windows"),
    )
    # Equal windows meet when sorted with their places; texts without any are done.
    ordered = windows.withColumn(
        "ordered",
        F.expr(
            "IF(size(array_distinct(windows)) = size(windows), NULL,"
            " array_sort(transform(windows, (h, i) -> struct(h, i))))"
        ),
    ).drop("windows")
    places = ordered.withColumn(
        "places",
        F.expr(
            "array_sort(transform(filter(ordered, (x, k) ->"
            " x.h <=> get(ordered, k - 1).h OR x.h <=> get(ordered, k + 1).h), x -> x.i))"
        ),
    ).drop("ordered")
    # Sorted places: each window adds the words that the one before doesn't cover.
    return places.withColumn(
        "n_repeat_words",
        F.expr(
            "coalesce(aggregate(transform(places, (p, j) ->"
            f" CAST(least({WINDOW}, coalesce(p - get(places, j - 1), {WINDOW})) AS BIGINT)), 0L, (a, b) -> a + b), 0L)"
        ),
    ).drop("places")


def _failed() -> Column:
    bits = [F.when(F.expr(test), F.lit(1 << i)).otherwise(0) for i, test in enumerate(RULES.values())]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return total.cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failed``, the bits of the rules that a document fails."""
    return measured(docs, id_col, text_col).withColumn("failed", _failed())


def kept_by(rules: Iterable[str]) -> Column:
    """Whether a ledger row passes all these rules."""
    return F.col("failed").bitwiseAND(F.lit(mask(rules)).cast("long")) == 0


def judged(entries: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """A ledger with the verdicts of the base rules and of a policy."""
    return entries.withColumns(
        {
            "base_failed": ~kept_by(POLICIES["base"]),
            "kept": kept_by({*POLICIES["base"], *POLICIES[version]}),
        }
    )


def ablation(entries: DataFrame, version: str = PRODUCTION) -> DataFrame:
    """For each rule of a policy: documents that fail it, that only it rejects, and that it rejects first.

    The ledger is counted once per pattern of failed bits; rules meet those
    counts only, at most two to the power of the rules.
    """
    whole = mask(POLICIES[version])
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(whole).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    bits = [(name, mask([name])) for name in POLICIES[version]]
    rows = patterns.select("bits", "n", F.explode(F.array(*(F.struct(F.lit(k).alias("rule"), F.lit(b).cast("long").alias("bit")) for k, b in bits))).alias("r")).select("bits", "n", "r.*")
    hit = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return rows.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_only"),
        F.sum(F.when(hit & (F.col("bits").bitwiseAND(F.col("bit") - 1) == 0), F.col("n")).otherwise(0)).alias("n_first"),
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
    SELECT r, doc_id, t,
        list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
),
g AS (
    SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n
    FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w)
),
c AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words
    FROM (SELECT r, i, unnest([0, 1, 2]) AS k FROM g WHERE n > 1) GROUP BY r
),
m AS (
    SELECT doc_id,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(words) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(len(lines) AS BIGINT) AS n_lines,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(len(list_filter(words, lambda x: regexp_matches(x, '\p{L}'))) AS BIGINT) AS n_letter_words,
        CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN c USING (r)
),
f AS (
    SELECT *,
        CAST(1 * (n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
        + 4 * (10 * n_symbols > n_words)::INT + 8 * (100 * n_dup_lines > 50 * n_lines)::INT
        + 16 * (word_chars < 3 * n_words)::INT + 32 * (word_chars > 12 * n_words)::INT
        + 64 * (10 * n_letter_words < 7 * n_words)::INT
        + 128 * (n_lines > 20 AND n_words < 3 * n_lines)::INT AS BIGINT) AS failed
    FROM m
)
SELECT *, failed % 4 > 0 AS base_failed, failed = 0 AS kept FROM f
"""

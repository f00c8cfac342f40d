"""Independent SQL for every registered query, runnable by DuckDB.

Written as the reference writes it: derived tables, CASE bins, window ranks
over aggregates, an EXISTS filter for computed keys, a CASE for fines.
Nothing is imported from the code under test but the names of queries: bins, months, pattern
and fines are spelt out here once more. Types are cast to what Spark returns (INTEGER for
years, ranks and bins; BIGINT for counts; DOUBLE for centroids).
"""

from __future__ import annotations

from .registry import HIST_COLUMNS, TOP5_KEYS

TICKETS_SQL = """
tickets AS (
  SELECT
    CAST(CASE WHEN l_partkey % 20 = 0 THEN NULL ELSE l_orderkey * 1000000 + l_partkey * 10 + l_linenumber END AS BIGINT) AS summons_number,
    CAST(year(o_orderdate) AS INTEGER) AS file_year,
    CASE WHEN l_orderkey % 149 = 0 THEN NULL ELSE strftime(l_shipdate, '%m/%d/%Y') END AS issue_date,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE
      lpad(CAST(CASE WHEN h >= 13 THEN h - 12 WHEN h = 0 AND l_linenumber % 2 = 0 THEN 12
                      WHEN h = 12 AND l_linenumber % 2 = 1 THEN 0 ELSE h END AS VARCHAR), 2, '0')
      || lpad(CAST((l_partkey * 11 + l_linenumber) % 60 AS VARCHAR), 2, '0')
      || CASE WHEN h >= 12 THEN 'P' ELSE 'A' END
    END AS violation_time,
    CAST(CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE (l_partkey % 10) * l_linenumber + 1 END AS INTEGER) AS violation_code,
    CAST(CASE WHEN l_suppkey % 25 BETWEEN 9 AND 14 THEN 8 ELSE l_suppkey % 25 END AS INTEGER) AS violation_precinct,
    CAST(CASE WHEN l_orderkey % 16 = 0 THEN 0 ELSE l_suppkey % 25 END AS INTEGER) AS issuer_precinct,
    CASE WHEN l_orderkey % 131 = 0 THEN NULL WHEN c_nationkey = 24 THEN '99' WHEN c_nationkey = 23 THEN '9A' WHEN c_nationkey = 22 THEN '#1'
         ELSE chr(CAST(65 + c_nationkey AS INTEGER)) || 'Y' END AS registration_state,
    p_type AS vehicle_body_type,
    p_brand AS vehicle_make,
    CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS house_number,
    CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE p_name END AS street_name
  FROM (SELECT *, (l_orderkey * 7 + l_partkey * 5 + l_linenumber) % 24 AS h FROM lineitem) l
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
),
clean AS (
  SELECT * FROM tickets WHERE substring(issue_date, 7, 4) = CAST(file_year AS VARCHAR)
)"""


def _with(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return f"WITH {TICKETS_SQL.strip()}{extra}\n{body.strip()}\n"


def _time_bin_case(otherwise: str = "") -> str:
    return f"""CASE
    WHEN violation_time[5:5] = 'A' AND violation_time[1:2] BETWEEN '00' AND '03' THEN 'Early_Morning_AM'
    WHEN violation_time[5:5] = 'A' AND violation_time[1:2] BETWEEN '04' AND '07' THEN 'Morning_AM'
    WHEN violation_time[5:5] = 'A' AND violation_time[1:2] BETWEEN '08' AND '11' THEN 'Before_Noon_AM'
    WHEN violation_time[5:5] = 'P' AND (violation_time[1:2] = '12' OR violation_time[1:2] BETWEEN '01' AND '03') THEN 'After_Noon_PM'
    WHEN violation_time[5:5] = 'P' AND violation_time[1:2] BETWEEN '04' AND '07' THEN 'Evening_PM'
    WHEN violation_time[5:5] = 'P' AND violation_time[1:2] BETWEEN '08' AND '11' THEN 'Night_PM'
    {otherwise}
  END"""


_SEASON_CASE = """CASE
    WHEN issue_date[1:2] BETWEEN '03' AND '05' THEN 'Spring'
    WHEN issue_date[1:2] BETWEEN '06' AND '08' THEN 'Summer'
    WHEN issue_date[1:2] BETWEEN '09' AND '11' THEN 'Fall'
    WHEN issue_date[1:2] IN ('12', '01', '02') THEN 'Winter'
  END"""


def _top_k(key: str, k: int) -> str:
    return _with(
        f"""
SELECT file_year, {key}, n, CAST(rk AS INTEGER) AS rk FROM (
  SELECT file_year, {key}, count({key}) AS n,
         row_number() OVER (PARTITION BY file_year ORDER BY count({key}) DESC, {key} ASC NULLS LAST) AS rk
  FROM clean GROUP BY file_year, {key}
) t WHERE rk <= {k}
"""
    )


def _hist(col: str, nbins: int = 12) -> str:
    return _with(
        f"""
SELECT s.file_year, CAST(g.bin AS INTEGER) AS bin,
       (CAST(s.lo AS DOUBLE) * {2 * nbins} + CAST(2 * g.bin + 1 AS DOUBLE) * CAST(s.hi - s.lo AS DOUBLE))
         / CAST({2 * nbins} AS DOUBLE) AS centroid,
       count(b.bin) AS n
FROM s
CROSS JOIN (SELECT range AS bin FROM range(0, {nbins})) g
LEFT JOIN b ON b.file_year = s.file_year AND b.bin = g.bin
GROUP BY s.file_year, g.bin, s.lo, s.hi
""",
        f"""s AS (
  SELECT file_year, min({col}) AS lo, max({col}) AS hi FROM clean WHERE {col} IS NOT NULL GROUP BY file_year
)""",
        f"""b AS (
  SELECT c.file_year,
         CASE WHEN s.hi = s.lo THEN 0
              ELSE greatest(((CAST(c.{col} AS BIGINT) - s.lo) * {nbins} + (s.hi - s.lo) - 1) // (s.hi - s.lo) - 1, 0)
         END AS bin
  FROM clean c JOIN s ON c.file_year = s.file_year
  WHERE c.{col} IS NOT NULL
)""",
    )


_TOP_PAIRS_CTES = (
    """top_precincts AS (
  SELECT file_year, issuer_precinct FROM (
    SELECT file_year, issuer_precinct,
           row_number() OVER (PARTITION BY file_year ORDER BY count(issuer_precinct) DESC,
                              issuer_precinct ASC NULLS LAST) AS r
    FROM clean GROUP BY file_year, issuer_precinct
  ) t WHERE r <= 3
)""",
    """top_pairs AS (
  SELECT file_year, issuer_precinct, violation_code, n, rk FROM (
    SELECT file_year, issuer_precinct, violation_code, count(violation_code) AS n,
           row_number() OVER (PARTITION BY file_year ORDER BY count(violation_code) DESC,
                              issuer_precinct ASC NULLS LAST, violation_code ASC NULLS LAST) AS rk
    FROM clean c
    WHERE EXISTS (SELECT 1 FROM top_precincts p
                  WHERE p.file_year = c.file_year AND p.issuer_precinct = c.issuer_precinct)
    GROUP BY file_year, issuer_precinct, violation_code
  ) t WHERE rk <= 10
)""",
)

_FINE_CASE = (
    "CASE violation_code WHEN 1 THEN cnt * 55 WHEN 7 THEN cnt * 115 WHEN 19 THEN cnt * 50 WHEN 25 THEN cnt * 50 END"
)

_REVENUE_CTE = f"""revenue AS (
  SELECT file_year, violation_code, cnt, {_FINE_CASE} AS amount FROM (
    SELECT file_year, violation_code, count(violation_code) AS cnt,
           row_number() OVER (PARTITION BY file_year ORDER BY count(violation_code) DESC,
                              violation_code ASC NULLS LAST) AS r
    FROM clean
    WHERE violation_code IS NOT NULL AND issue_date IS NOT NULL
    GROUP BY file_year, violation_code
  ) t WHERE r <= 3
)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["row_counts"] = _with(
        """
SELECT 'loaded' AS stage, count(*) AS n FROM tickets
UNION ALL
SELECT 'clean' AS stage, count(*) AS n FROM clean
"""
    )
    q["union_years"] = _with(
        """
SELECT file_year, count(*) AS n FROM tickets GROUP BY file_year
UNION ALL
SELECT CAST(NULL AS INTEGER) AS file_year, count(*) AS n FROM tickets
"""
    )
    q["csv_ingest"] = _with(
        """
SELECT file_year, count(*) AS n,
  count(*) - count(summons_number) AS null_summons_number, count(*) - count(registration_state) AS null_registration_state,
  count(*) - count(issue_date) AS null_issue_date, count(*) - count(violation_time) AS null_violation_time,
  count(*) - count(house_number) AS null_house_number, count(*) - count(street_name) AS null_street_name,
  CAST(sum(summons_number) AS BIGINT) AS sum_summons, CAST(sum(violation_code) AS BIGINT) AS sum_code,
  CAST(sum(violation_precinct) AS BIGINT) AS sum_precinct, CAST(sum(issuer_precinct) AS BIGINT) AS sum_issuer,
  count(DISTINCT vehicle_make) AS n_makes, count(DISTINCT vehicle_body_type) AS n_body_types
FROM tickets GROUP BY file_year
"""
    )
    q["csv_broken_records"] = _with(
        """
SELECT file_year, reason, count(*) AS n, CAST(sum(length(CAST(summons_number AS VARCHAR)) + more) AS BIGINT) AS chars FROM (
  SELECT file_year, summons_number,
    CASE summons_number % 120 WHEN 3 THEN 'too long' WHEN 43 THEN 'too short' WHEN 83 THEN 'open quote' END AS reason,
    CASE summons_number % 120 WHEN 3 THEN 51 WHEN 43 THEN 41 WHEN 83 THEN 44 END AS more
  FROM tickets
) t WHERE reason IS NOT NULL GROUP BY file_year, reason
"""
    )
    q["csv_inferred_types"] = _with(
        """
SELECT file_year, 'feet_from_curb' AS column_name, 'double' AS type, count(violation_code) AS n,
  CAST(coalesce(sum(violation_code * 10 + half * 5), 0) AS DOUBLE) AS total FROM halves GROUP BY file_year
UNION ALL
SELECT file_year, 'vehicle_year', 'bigint', count(summons_number),
  CAST(coalesce(sum((CAST(summons_number AS HUGEINT) + half * 1000000000000) * 10), 0) AS DOUBLE) FROM halves GROUP BY file_year
UNION ALL
SELECT file_year, 'meter_number', 'string', count(violation_code),
  CAST(coalesce(sum(CASE half WHEN 0 THEN 4 ELSE 1 + length(CAST(violation_code AS VARCHAR)) END) FILTER (WHERE violation_code IS NOT NULL), 0) AS DOUBLE)
FROM halves GROUP BY file_year
UNION ALL
SELECT file_year, 'unregistered_vehicle', 'int', count(violation_code) FILTER (WHERE half = 1),
  CAST(coalesce(sum(violation_code * 10) FILTER (WHERE half = 1), 0) AS DOUBLE) FROM halves GROUP BY file_year
""",
        "halves AS (SELECT *, (coalesce(violation_precinct, 0) + coalesce(length(street_name), 0)) % 2 AS half FROM tickets)",
    )
    told = """count(*) AS n, CAST(sum(summons_number) AS BIGINT) AS sum_summons,
  count(*) FILTER (WHERE house_number IS NULL OR street_name IS NULL) AS n_missing_address, count(*) - count(violation_time) AS n_missing_time"""
    q["top5_streets"] = _top_k("street_name", 5)
    q["peak_year_precincts"] = _with(
        f"""
SELECT file_year, issuer_precinct, {told} FROM clean c
WHERE file_year = (SELECT file_year FROM clean GROUP BY file_year ORDER BY count(*) DESC, file_year LIMIT 1)
  AND EXISTS (SELECT 1 FROM top_precincts p WHERE p.file_year = c.file_year AND p.issuer_precinct = c.issuer_precinct)
GROUP BY file_year, issuer_precinct
""",
        _TOP_PAIRS_CTES[0],
    )
    q["code_lookup"] = _with(
        f"""
SELECT file_year, violation_code, issuer_precinct, {told} FROM clean
WHERE (violation_code = 7 OR violation_code = 13 OR violation_code = 25) AND (issuer_precinct = 0 OR issuer_precinct = 8 OR issuer_precinct = 19)
GROUP BY file_year, violation_code, issuer_precinct
"""
    )
    q["csv_top_codes"] = _top_k("violation_code", 3)
    q["csv_unique_states"] = _with(
        """
SELECT file_year, count(DISTINCT registration_state) AS n_states FROM clean
WHERE registration_state <> '99' GROUP BY file_year
"""
    )
    q["issue_years"] = _with(
        "SELECT DISTINCT substring(issue_date, 7, 4) AS issue_year FROM tickets ORDER BY issue_year DESC"
    )
    q["clean_counts"] = _with("SELECT file_year, count(*) AS n FROM clean GROUP BY file_year")
    q["null_profile"] = _with(
        "\nUNION ALL\n".join(
            f"SELECT '{c}' AS column_name, file_year, count(*) AS n FROM clean WHERE {c} IS NULL GROUP BY file_year"
            for c in ("summons_number", "registration_state", "issue_date", "violation_code", "violation_time")
        )
    )
    q["invalid_states"] = _with(
        "SELECT DISTINCT registration_state FROM clean"
        " WHERE registration_state[1:1] NOT BETWEEN 'A' AND 'Z' AND registration_state[2:2] NOT BETWEEN 'A' AND 'Z'"
        " AND length(registration_state) >= 2"
    )
    for name, col in HIST_COLUMNS.items():
        q[name] = _hist(col)
    q["ticket_count_by_year"] = _with(
        "SELECT file_year, count(summons_number) AS n FROM clean GROUP BY file_year"
    )
    q["unique_states_by_year"] = _with(
        """
SELECT file_year, count(DISTINCT registration_state) AS n_states
FROM clean WHERE registration_state != '99' GROUP BY file_year
"""
    )
    q["state_counts"] = _with(
        """
SELECT file_year, registration_state, count(registration_state) AS n
FROM clean WHERE registration_state != '99' GROUP BY file_year, registration_state
"""
    )
    q["missing_address"] = _with(
        """
SELECT file_year, count(*) AS n FROM clean
WHERE house_number IS NULL OR street_name IS NULL GROUP BY file_year
"""
    )
    for name, key in TOP5_KEYS.items():
        q[name] = _top_k(key, 5)
    q["codes_in_top_precincts"] = _with(
        "SELECT file_year, issuer_precinct, violation_code, n, CAST(rk AS INTEGER) AS rk FROM top_pairs",
        *_TOP_PAIRS_CTES,
    )
    q["code_overlap"] = _with(
        """
SELECT file_year, violation_code, count(DISTINCT issuer_precinct) AS n_precincts
FROM top_pairs GROUP BY file_year, violation_code
""",
        *_TOP_PAIRS_CTES,
    )
    q["top3_codes_by_time_bin"] = _with(
        f"""
SELECT file_year, time_bin, violation_code, n, CAST(rk AS INTEGER) AS rk FROM (
  SELECT file_year, time_bin, violation_code, count(violation_code) AS n,
         dense_rank() OVER (PARTITION BY file_year, time_bin ORDER BY count(violation_code) DESC) AS rk
  FROM (SELECT file_year, violation_code, {_time_bin_case()} AS time_bin FROM clean) t
  GROUP BY file_year, time_bin, violation_code
) t1 WHERE time_bin IS NOT NULL AND rk <= 3
"""
    )
    q["top3_codes"] = _top_k("violation_code", 3)
    q["time_bins_of_top_codes"] = _with(
        f"""
SELECT file_year, time_bin, count(violation_code) AS n FROM (
  SELECT file_year, violation_code, {_time_bin_case("ELSE ''")} AS time_bin
  FROM clean c
  WHERE EXISTS (SELECT 1 FROM top_codes t WHERE t.file_year = c.file_year AND t.violation_code = c.violation_code)
) x GROUP BY file_year, time_bin
""",
        """top_codes AS (
  SELECT file_year, violation_code FROM (
    SELECT file_year, violation_code,
           row_number() OVER (PARTITION BY file_year ORDER BY count(violation_code) DESC,
                              violation_code ASC NULLS LAST) AS r
    FROM clean GROUP BY file_year, violation_code
  ) t WHERE r <= 3
)""",
    )
    q["season_counts"] = _with(
        f"""
SELECT file_year, season, count(summons_number) AS n FROM (
  SELECT file_year, summons_number, {_SEASON_CASE} AS season FROM clean
) t WHERE season IS NOT NULL GROUP BY file_year, season
"""
    )
    q["top3_codes_by_season"] = _with(
        f"""
SELECT file_year, season, violation_code, n, CAST(rk AS INTEGER) AS rk FROM (
  SELECT file_year, season, violation_code, count(summons_number) AS n,
         dense_rank() OVER (PARTITION BY file_year, season ORDER BY count(violation_code) DESC) AS rk
  FROM (SELECT file_year, summons_number, violation_code, {_SEASON_CASE} AS season FROM clean) t
  GROUP BY file_year, season, violation_code
) t1 WHERE season IS NOT NULL AND rk <= 3
"""
    )
    q["revenue_top3"] = _with("SELECT file_year, violation_code, cnt, amount FROM revenue", _REVENUE_CTE)
    q["top_revenue_code"] = _with(
        """
SELECT file_year, violation_code, amount FROM (
  SELECT file_year, violation_code, amount,
         row_number() OVER (PARTITION BY file_year ORDER BY amount DESC NULLS LAST, violation_code ASC) AS r
  FROM revenue
) t WHERE r = 1
""",
        _REVENUE_CTE,
    )
    return q

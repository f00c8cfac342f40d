"""The derived citation table has the shape FIXTURES.md §F2 records."""

from pyspark.sql import functions as F

from ticketlens.operators.clean import keep_issue_year
from ticketlens.schema import TICKET_COLUMNS
from ticketlens.sources.fixture import fixture_years, stored_tickets, tickets


def _by_year(df):
    return {r["file_year"]: r["count"] for r in df.groupBy("file_year").count().collect()}


def test_rows_per_year(spark, sf_dir):
    t = tickets(spark, sf_dir)
    assert tuple(t.columns) == TICKET_COLUMNS
    assert _by_year(t) == {1995: 962, 1996: 920, 1997: 908, 1998: 957, 1999: 945, 2000: 816, 2001: 492}
    assert _by_year(keep_issue_year(t)) == {1995: 142, 1996: 140, 1997: 133, 1998: 111, 1999: 144, 2000: 125, 2001: 67}


def test_stored_table_equals_derivation(spark, sf_dir):
    a = stored_tickets(spark, sf_dir)
    b = tickets(spark, sf_dir)
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dirt_counts(spark, sf_dir):
    clean = keep_issue_year(stored_tickets(spark, sf_dir))
    states = {r[0]: r[1] for r in clean.groupBy("registration_state").count().collect()}
    assert (states["99"], states["9A"], states["#1"], states[None]) == (37, 19, 29, 6)
    assert clean.where("summons_number IS NULL").count() == 41
    assert clean.where("violation_time LIKE '00__P'").count() == 13
    assert clean.where("violation_time IS NULL").count() == 11
    missing = _by_year(clean.where(F.col("house_number").isNull() | F.col("street_name").isNull()))
    assert missing == {1995: 24, 1996: 24, 1997: 38, 1998: 33, 1999: 49, 2000: 22, 2001: 21}


def test_stored_under_the_shared_folder(spark, sf_dir):
    from ticketlens.sources.store import ensure_shared_dir

    base = ensure_shared_dir(spark).split(":", 1)[-1].lstrip("/")
    files = stored_tickets(spark, sf_dir).inputFiles()
    assert files and all(base in f for f in files)
    folders = {f.split("/file_year=")[1].split("/")[0] for f in files}
    assert folders == {str(y) for y in range(1995, 2002)}
    assert fixture_years(spark, sf_dir) == list(range(1995, 2002))


def test_cluster_without_shared_folder_is_refused():
    import pytest

    from ticketlens.sources.store import ensure_shared_dir

    class Ctx:
        master = "yarn"
        applicationId = "app-1"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext = Ctx()
        conf = Conf()

    with pytest.raises(RuntimeError):
        ensure_shared_dir(Session())


def test_the_fixture_tells_the_rules_apart(spark, sf_dir):
    """An empty bin, and a season where summons and code counts rank differently."""
    from ticketlens.plans import analyses as A
    from ticketlens.sources.fixture import stored_clean

    clean = stored_clean(spark, sf_dir)
    assert any(r["n"] == 0 for r in A.hist(clean, "violation_precinct", 12).collect())
    rows = A.top3_codes_by_season(clean).collect()
    shown = {}
    for r in rows:
        shown.setdefault((r["file_year"], r["season"]), []).append((r["rk"], -r["n"]))
    assert any([n for _, n in sorted(v)] != sorted(n for _, n in v) for v in shown.values())


def test_the_shared_folder_is_one(spark):
    from ticketlens.sources.store import ensure_shared_dir

    assert ensure_shared_dir(spark) == ensure_shared_dir(spark)


def test_forget_removes_own_files(spark):
    from ticketlens.sources import store

    df = spark.createDataFrame([(2015, "a")], "file_year int, x string")
    scan = store.stored(spark, "own-test", lambda: df)
    name = scan.inputFiles()[0].removeprefix("file://")
    import os

    assert os.path.exists(name)
    store.forget(spark)
    assert not os.path.exists(name)


def test_joins_move_numbers_and_have_tasks_for_their_lines(spark, sf_dir, monkeypatch):
    """Text is formed above every exchange; few shuffle partitions don't make a task's lines grow with the table."""
    from ticketlens.sources import fixture

    rows = tickets(spark, sf_dir)
    monkeypatch.setattr(fixture, "EACH", 500)
    dealt = tickets(spark, sf_dir)
    plan = dealt._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count(", 12), REPARTITION_BY_NUM") == 2, plan
    below = plan[plan.index("Exchange"):]
    assert "violation_time" in plan and not any(c in below for c in ("violation_time", "registration_state", "house_number")), plan
    assert dealt.exceptAll(rows).count() == 0 and dealt.count() == rows.count()


def test_stored_rows_are_formed_after_the_deal(spark):
    from ticketlens.sources import store

    df = spark.createDataFrame([(2015, 1), (2016, 2), (2015, None)], "file_year int, x int")
    seen = []

    def formed(rows):
        seen.append(rows._jdf.queryExecution().analyzed().toString())
        return rows.select("file_year", (rows["x"] * 2).alias("y"))

    scan = store.stored(spark, "formed-test", lambda: df, formed=formed)
    assert sorted(map(tuple, scan.collect()), key=repr) == [(2015, 2), (2015, None), (2016, 4)]
    assert "RebalancePartitions" in seen[0] or "rebalance" in seen[0].lower()

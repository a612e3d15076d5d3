import datetime
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.plans.tables import TOUCHED, layout
from shelfmark.sources.tables import drop_intermediate
from shelfmark.sources.touches import TouchLog, Touched, combined, fold, log_of, rows_of, touches

DDL = "k int, name string, seen date, told string, update_dts timestamp_ntz, create_dts timestamp_ntz, load_audit_id int"
TABLE = Touched(("k",), {"seen": ("seen",), "told": ("told", "update_dts")})
START = datetime.datetime(2016, 1, 1)


def at(day):
    return START + datetime.timedelta(days=day)


def one_by_one(loads):
    """The rows after the loads in the order of their time, each applied to what is stored."""
    stored = {}
    for day, number, kind, values in sorted(loads):
        for k, v in values.items():
            if k in stored:
                if kind == "seen":
                    stored[k]["seen"] = at(day).date()
                if kind == "told":
                    stored[k] |= {"told": v, "update_dts": at(day)}
            elif kind != "told":
                stored[k] = {"name": v, "seen": at(day).date(), "told": None, "update_dts": None,
                             "create_dts": at(day), "load_audit_id": number}
    return sorted((k, *r.values()) for k, r in stored.items())


def said(spark, log, day, number, kind, values):
    """A load's touches: seen creates and sees, told only tells, found only creates."""
    staged = spark.createDataFrame(list(values.items()) or [], "k int, v string")
    when = at(day).isoformat(sep=" ")
    date = F.lit(when).cast("date")
    creates = None if kind == "told" else {"name": F.col("v"), "seen": date}
    sets = {"seen": {"seen": {"seen": date}}, "told": {"told": {"told": F.col("v"), "update_dts": F.lit(when)}}}.get(kind, {})
    return touches(log.touched, log.layout, staged, when, number, creates, sets)


@pytest.fixture()
def log(spark, tmp_path):
    return log_of(spark, str(tmp_path / "log"), DDL, TABLE)


@pytest.mark.parametrize("seed", range(3))
def test_equals_loads_applied_one_by_one(spark, log, seed):
    rnd = random.Random(seed)
    made = [
        (rnd.randrange(6), n, rnd.choice(["seen", "told", "found"]), {rnd.randrange(8): f"{n}{rnd.choice('ab')}" for _ in range(4)})
        for n in range(1, 10)]
    arriving = made + rnd.sample(made, 2)
    rnd.shuffle(arriving)
    folds = rnd.sample(range(len(arriving)), 2)
    for i, (day, number, kind, values) in enumerate(arriving):
        log.append(number, said(spark, log, day, number, kind, values))
        if i in folds:
            log.fold()
    assert sorted(tuple(r) for r in log.read().collect()) == one_by_one(made)
    assert log.read().schema.simpleString() == layout_string(DDL, spark)
    drop_intermediate(spark)


def layout_string(ddl, spark):
    return spark.createDataFrame([], ddl).schema.simpleString()


def test_a_load_writes_its_own_keys_only(spark, log, tmp_path):
    log.append(1, said(spark, log, 0, 1, "seen", {k: "x" for k in range(2000)}))
    log.fold()
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet")}
    assert log.append(2, said(spark, log, 1, 2, "seen", {3: "y", 5000: "y"})) == 2
    after = {p: p.stat().st_mtime_ns for p in (tmp_path / "log").rglob("*.parquet")}
    assert before.items() <= after.items() and before
    assert spark.read.parquet(str(tmp_path / "log" / "batch=2")).count() == 2
    assert log.read().count() == 2001
    assert {r.k for r in log.read().filter("seen > date '2016-01-01'").collect()} == {3, 5000}
    # The many stored rows stay where they are; the few touches go to them.
    plan = log.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in plan
    drop_intermediate(spark)


def test_a_large_log_meets_the_folded_states_once(spark, log):
    """Beside few folded states the log is not folded for each of several joins."""
    log.append(1, said(spark, log, 0, 1, "seen", {k: "x" for k in range(50)}))
    log.fold()
    log.append(2, said(spark, log, 1, 2, "seen", {k: "y" for k in range(25, 90)}))
    plan = log.read()._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {r.k: r.seen.isoformat() for r in log.read().collect()}.keys() == set(range(90))
    assert log.fold() == 2 and log.read().count() == 90
    drop_intermediate(spark)


def test_a_load_taken_out_is_undone(spark, log):
    log.append(1, said(spark, log, 0, 1, "seen", {1: "x"}))
    log.append(2, said(spark, log, 1, 2, "seen", {1: "y", 2: "y"}))
    log.append(3, said(spark, log, 2, 3, "told", {1: "z"}))
    log.drop(2)
    assert [tuple(r) for r in log.read().collect()] == [
        (1, "x", at(0).date(), "z", at(2), at(0), 1)]
    # A repeated load that has nothing to say any more takes its earlier rows back.
    assert log.append(3, said(spark, log, 2, 3, "told", {})) == 0
    assert log.loads() == [1] and log.read().first().told is None


def test_a_broken_fold_changes_nothing(spark, log, tmp_path):
    import shutil

    log.append(1, said(spark, log, 0, 1, "seen", {1: "x", 2: "x"}))
    log.append(2, said(spark, log, 1, 2, "told", {1: "z"}))
    rows = sorted(tuple(r) for r in log.read().collect())
    shutil.copytree(tmp_path / "log", tmp_path / "kept")
    assert log.fold() == 2 and log.loads() == [-1]
    for name in ("batch=1", "batch=2"):  # the fold ended before it took these away
        shutil.copytree(tmp_path / "kept" / name, tmp_path / "log" / name)
    assert sorted(tuple(r) for r in log.read().collect()) == rows
    assert log.fold() == 3 and log.loads() == [-2]
    shutil.copytree(tmp_path / "kept" / "batch=1", tmp_path / "log" / "batch=-1")
    assert sorted(tuple(r) for r in log.read().collect()) == rows
    assert log.fold() == 2 and log.fold() == 0
    assert sorted(tuple(r) for r in log.read().collect()) == rows
    drop_intermediate(spark)


def test_nulls_and_empty_tables(spark, log):
    assert log.read().count() == 0 and log.fold() == 0
    staged = spark.createDataFrame([(None, "a"), (1, None)], "k int, v string")
    log.append(1, touches(TABLE, log.layout, staged, "2016-01-01 00:00:00", 1, {"name": F.col("v")}, {}))
    assert [(r.k, r.name, r.load_audit_id) for r in log.read().collect()] == [(1, None, 1)]
    # A touch may set a null.
    log.append(2, said(spark, log, 1, 2, "told", {1: "t"}))
    log.append(3, said(spark, log, 2, 3, "told", {1: None}))
    assert log.read().first().told is None and log.read().first().update_dts == at(2)


def test_states_combine_in_any_grouping(spark, log):
    parts = [said(spark, log, d, n, kind, {1: str(n), n: "x"}) for n, (d, kind) in enumerate(
        [(3, "seen"), (1, "told"), (2, "seen"), (5, "told")], start=1)]
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    left = fold(TABLE, parts[0].union(parts[3]))
    right = fold(TABLE, parts[1].union(parts[2]).union(parts[3]))
    rows = [sorted(tuple(r) for r in rows_of(TABLE, log.layout, x).collect()) for x in (
        fold(TABLE, whole), combined(TABLE, left, right), combined(TABLE, right, left), fold(TABLE, left.union(right)))]
    assert rows[0] == rows[1] == rows[2] == rows[3] and len(rows[0]) == 2


def test_every_kept_table_has_its_columns(spark, tmp_path):
    for name, touched in TOUCHED.items():
        table = TouchLog(spark, str(tmp_path / name), layout(name), touched)
        assert table.read().schema == layout(name)

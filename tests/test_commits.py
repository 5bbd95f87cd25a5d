"""The lead store's versions: rows of one key in order, writers at once, and ends at any step."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from brightsieve.sources.store import LeadStore, folded

T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


@pytest.fixture
def rows(spark):
    return lambda *r: spark.createDataFrame(list(r), "record_id string, company string, city string")


def content(store):
    return {r.record_id: (r.company, r.city) for r in LeadStore(store.spark, store.root, store.name).frame().collect()}


def by_rows(old, new):
    """The rows one after the other, as a row-wise loader inserts and updates them."""
    held, inserted, updated, errors = dict(old), 0, 0, 0
    for key, *values in new:
        if not key:
            errors += 1
        elif key in held:
            held[key] = tuple(v if v is not None else o for v, o in zip(values, held[key]))
            updated += 1
        else:
            held[key] = tuple(values)
            inserted += 1
    return held, {"inserted": inserted, "updated": updated, "errors": errors}


def test_rows_of_one_key_in_order(spark, rows, tmp_path):
    s = LeadStore(spark, str(tmp_path / "t"), "t_order")
    first = [("1", "zeta", "Bonn"), ("1", "alpha", None), ("2", None, "Ulm"), ("", "x", "y"), (None, "x", "y")]
    told = s.upsert(rows(*first), T0)
    held, want = by_rows({}, first)
    assert content(s) == held == {"1": ("alpha", "Bonn"), "2": (None, "Ulm")} and {k: told[k] for k in want} == want
    second = [("2", "b", None), ("3", None, None), ("2", "a", "Hof"), ("3", "c", None), ("1", None, None), ("3", None, "Gera"), ("2", None, None)]
    told = s.upsert(rows(*second), T1)
    held, want = by_rows(held, second)
    assert content(s) == held and {k: told[k] for k in want} == want
    assert {r.record_id: (r.created_at, r.updated_at) for r in s.frame().collect()} == {"1": (T0, T1), "2": (T0, T1), "3": (T1, T1)}


def test_fold(spark, rows):
    many = spark.range(200_000, numPartitions=8).selectExpr("CASE WHEN id % 10 < 9 THEN 'hot' ELSE concat('k', id % 100) END AS record_id", "IF(id % 3 = 0, NULL, concat('c', id)) AS company", "id AS at")
    plan = folded(many, order=["at"])._jdf.queryExecution().toString()
    assert "partial_max_by" in plan  # a hot key is reduced where its rows are read
    got = {r.record_id: (r.company, r.asDict()["__rows"]) for r in folded(many, order=["at"]).collect()}
    assert got["hot"] == ("c199997", 180_000) and len(got) == 11
    assert folded(rows().limit(0)).count() == 0
    tied = rows(("a", "x", None), ("a", "y", "z")).selectExpr("*", "1 AS at")
    assert folded(tied, order=["at"]).select("company", "city").collect() == folded(tied.orderBy("company", ascending=False), order=["at"]).select("company", "city").collect() == [("y", "z")]


def test_only_touched_buckets_are_rewritten(spark, rows, tmp_path):
    s = LeadStore(spark, str(tmp_path / "t"), "t_buckets", buckets=8)
    s.upsert(rows(*[(f"k{i}", "c", None) for i in range(100)]), T0)
    before = s._snapshot(s._version())["data"]
    s.upsert(rows(("k7", "new", None)), T1)
    after = s._snapshot(s._version())["data"]
    assert len(before) == 8 and sum(before[k] != after[k] for k in before) == 1
    assert content(s) == {f"k{i}": ("new" if i == 7 else "c", None) for i in range(100)}


class Ends(Exception):
    pass


@pytest.mark.parametrize("step", ["_written", "_put", "link"])
def test_an_end_at_any_step_keeps_all_rows(spark, rows, tmp_path, monkeypatch, step):
    s = LeadStore(spark, str(tmp_path / "t"), "t_end")
    s.upsert(rows(("1", "a", "b")), T0)

    def ends(*a, **k):
        raise Ends

    if step == "link":
        monkeypatch.setattr(os, "link", ends)
    elif step == "_written":  # the data is written, and no version names it
        true = LeadStore._written
        monkeypatch.setattr(LeadStore, "_written", lambda self, df: (true(self, df), ends()))
    else:
        monkeypatch.setattr(LeadStore, step, ends)
    with pytest.raises(Ends):
        s.upsert(rows(("1", "changed", None), ("2", "x", None)), T1)
    monkeypatch.undo()
    assert content(s) == {"1": ("a", "b")}
    s.upsert(rows(("2", "x", None)), T1)
    assert content(s) == {"1": ("a", "b"), "2": ("x", None)}
    held = content(s)
    assert s.vacuum(hours=1) == 0 and s.vacuum(hours=-1) == 1 and s.vacuum(hours=-1) == 0 and content(s) == held


def test_a_writer_that_comes_second_starts_again(spark, rows, tmp_path):
    a = LeadStore(spark, str(tmp_path / "t"), "t_a", buckets=4)
    a.upsert(rows(("1", "a", "b"), ("2", "c", "d")), T0)
    other, calls = LeadStore(spark, a.root, "t_b"), []

    class Late(LeadStore):
        def _put(self, version, snapshot):
            calls.append(version)
            if len(calls) == 1:  # another one is faster
                other.upsert(rows(("1", None, "theirs"), ("3", "e", None)), T1)
            return super()._put(version, snapshot)

    assert Late(spark, a.root, "t_c").upsert(rows(("1", "mine", None)), T1)["updated"] == 1
    assert len(calls) == 2 and content(a) == {"1": ("mine", "theirs"), "2": ("c", "d"), "3": ("e", None)}
    calls.clear()

    class LateLoad(Late):
        pass

    assert LateLoad(spark, a.root, "t_d").load(rows(("9", "appended", None)))["inserted"] == 1
    assert content(a)["9"] == ("appended", None) and len(content(a)) == 4


def test_writers_at_once(spark, rows, tmp_path):
    where = str(tmp_path / "t")
    LeadStore(spark, where, "t_many").create()
    with ThreadPoolExecutor(4) as pool:
        told = list(pool.map(lambda k: LeadStore(spark, where, f"t_many_{k}").upsert(rows(*[(f"{i}", f"c{k}" if i % 4 == k else None, None) for i in range(20)]), T0), range(4)))
    assert sum(t["inserted"] for t in told) == 20 and sum(t["updated"] for t in told) == 60
    assert content(LeadStore(spark, where, "t_many")) == {f"{i}": (f"c{i % 4}", None) for i in range(20)}


def test_old_versions_go(spark, rows, tmp_path, monkeypatch):
    monkeypatch.setattr(LeadStore, "KEEP", 2)
    s = LeadStore(spark, str(tmp_path / "t"), "t_keep", buckets=2)
    for k in range(5):
        s.upsert(rows(("1", f"c{k}", None)), T0)
    assert len(s._names("_log")) == 2 and len([n for n in s._names("data") if s._names(f"data/{n}") != ["_SUCCESS"]]) == 2
    assert s.frame(s._version() - 1).first().company == "c3" and content(s) == {"1": ("c4", None)}


def test_older_layout_is_taken_over(spark, rows, tmp_path):
    old = LeadStore(spark, str(tmp_path / "made"), "t_made")
    old.upsert(rows(("1", "a", "b")), T0)
    for named in (True, False):  # the second: its writer ended between the two steps of naming a version
        where = tmp_path / f"old-{named}"
        old.frame().write.parquet(f"{where}/v20240101000000000000")
        if named:
            (where / "CURRENT").write_text("v20240101000000000000")
        s = LeadStore(spark, str(where), "t_old")
        s.upsert(rows(("2", "c", None)), T1)
        assert content(s) == {"1": ("a", "b"), "2": ("c", None)}


def test_no_key_at_all(spark, rows, tmp_path):
    s = LeadStore(spark, str(tmp_path / "t"), "t_none")
    assert s.upsert(rows((None, "a", "b")), T0) == {"inserted": 0, "updated": 0, "errors": 1, "table": "t_none"}
    assert s.upsert(rows(("1", "a", "b")).limit(0), T0)["errors"] == 0 and s.frame().count() == 0

"""Commits of logs and tables: writers at the same time, and writers that stop half-way."""

import json
import os
import subprocess
import sys
import threading

import pytest
from conftest import rows
from test_plans import feed

from demandloom import settings as s
from demandloom.operators import lifecycle as lc
from demandloom.plans import refresh as refresh_plan
from demandloom.plans.dataset import build_dataset
from demandloom.plans.modelbook import ModelBook
from demandloom.plans.refresh import refresh
from demandloom.sources.commits import CommitLog
from demandloom.sources.snapshots import Draft, Snapshots
from demandloom.sources.tables import read_table, read_tables, write_table


def test_writers_at_the_same_time_get_different_numbers(spark, tmp_path):
    folder = str(tmp_path / "log")
    taken, started = [], threading.Barrier(6)

    def work(who):
        log = CommitLog(spark, folder)
        started.wait()
        for _ in range(5):
            taken.append((log.append(lambda n: {"who": who, "seen": n - 1})["commit"], who))

    threads = [threading.Thread(target=work, args=(k,)) for k in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    log = CommitLog(spark, folder)
    assert sorted(n for n, _ in taken) == log.numbers() == list(range(1, 31))
    assert {(n, log.read(n)["who"]) for n in log.numbers()} == set(taken)
    # Each entry was made from all before it.
    assert all(log.read(n)["seen"] == n - 1 for n in log.numbers())
    frame = log.frame("who int, commit bigint")
    assert {(r["commit"], r["who"]) for r in frame.collect()} == set(taken)


def test_a_name_is_given_once_by_rename_too(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    (tmp_path / "log").mkdir()
    assert log._rename(1, json.dumps({"a": 1}))
    assert not log._rename(1, json.dumps({"a": 2}))
    assert log._rename(2, json.dumps({"a": 3}))
    assert [log.read(n)["a"] for n in log.numbers()] == [1, 3]
    assert not [f for f in os.listdir(log.folder) if f.endswith("json") is False and ".crc" not in f]


def test_half_written_entries_are_not_there(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() is None and log.frame("a int").count() == 0
    log.append(lambda n: {"a": 1})
    (tmp_path / "log" / ".left-behind").write_text("{\"a\": ")
    assert log.numbers() == [1] and log.frame("a int").count() == 1

    def fails(_):
        raise RuntimeError("no entry")

    with pytest.raises(RuntimeError):
        log.append(fails)
    assert log.append(lambda n: {"a": 2})["commit"] == 2


REGISTER = """
import sys
from demandloom.plans.modelbook import ModelBook
from demandloom.session import build_session
spark = build_session("writer", "local[1]", 1, {"spark.driver.memory": "1g"})
book = ModelBook(spark, sys.argv[1])
print("ready", flush=True)
sys.stdin.readline()
for k in range(3):
    version = book.register("demand", {"run_id": sys.argv[2] + str(k), "model_path": "m"})
    book.assign("demand", "Challenger", version, {"by": sys.argv[2]})
    print(version, flush=True)
"""


def test_two_processes_register(spark, tmp_path):
    root = str(tmp_path / "models")
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    writers = [
        subprocess.Popen(
            [sys.executable, "-c", REGISTER, root, name],
            stdin=subprocess.PIPE, stdout=subprocess.PIPE, text=True, cwd=here,
            env={**os.environ, "PYTHONPATH": here},
        )
        for name in ("a", "b")
    ]
    for writer in writers:
        assert writer.stdout.readline().strip() == "ready"
    for writer in writers:
        writer.stdin.write("go\n")
        writer.stdin.flush()
    given = [list(map(int, writer.communicate(timeout=300)[0].split())) for writer in writers]
    assert sorted(given[0] + given[1]) == [1, 2, 3, 4, 5, 6]
    book = ModelBook(spark, root)
    versions = {r["version"]: r["run_id"] for r in book.versions().collect()}
    assert sorted(versions) == [1, 2, 3, 4, 5, 6]
    assert [versions[v] for v in given[0]] == ["a0", "a1", "a2"]
    last = max(book.aliases().collect(), key=lambda r: r["commit"])
    assert book.holder("demand", "Challenger")["version"] == last["version"]


def test_the_later_commit_holds_an_alias_whatever_the_clocks_say(spark, tmp_path):
    book = ModelBook(spark, str(tmp_path))
    for version, clock in ((1, "2030-01-01T00:00:00+00:00"), (2, "2020-01-01T00:00:00+00:00")):
        run = {"run_id": f"r{version}", "model_path": "m"}
        assert book.register("demand", run) == version
        row = {"model_name": "demand", "alias": "Champion", "version": version, "tags": {"t": str(version)}}
        book._append("promotion_log", lc.ALIASES, {**row, "assigned_at": clock})
    assert book.holder("demand", "Champion")["version"] == 2


def test_tables_change_together(spark, tmp_path):
    root = str(tmp_path)
    snapshots = Snapshots(spark, root)
    for value in (1, 2):
        draft = snapshots.draft()
        for name in ("x", "y"):
            draft.write(name, spark.range(value))
        assert [read_table(spark, f"{root}/x").count() for _ in range(value - 1)] == [1] * (value - 1)
        snapshots.commit(draft)
    old = snapshots.log.read(1)
    x, y = read_tables(spark, [f"{root}/x", f"{root}/y"])
    assert (x.count(), y.count()) == (2, 2)
    # A table by itself leaves the others as they are; the one before is still there.
    write_table(spark.range(7), f"{root}/x")
    assert [t.count() for t in read_tables(spark, [f"{root}/x", f"{root}/y"])] == [7, 2]
    assert x.count() == 2
    snapshots.expire(keep=1)
    assert [t.count() for t in read_tables(spark, [f"{root}/x", f"{root}/y"])] == [7, 2]
    assert not os.path.exists(snapshots.paths("x", old)[0])


def test_drafts_left_behind_go_when_they_are_old(spark, tmp_path):
    snapshots = Snapshots(spark, str(tmp_path))
    write_table(spark.range(1), f"{tmp_path}/x")
    left = snapshots.draft()
    left.write("x", spark.range(3))
    assert snapshots.expire() == []
    assert snapshots.expire(older_than=-1) == [left.folder.split("/")[1]]
    assert read_table(spark, f"{tmp_path}/x").count() == 1


def test_rows_are_counted_by_the_write(spark, tmp_path):
    draft = Snapshots(spark, str(tmp_path)).draft()
    draft.write("some", spark.range(1000).where("id % 3 = 0"))
    draft.write("none", spark.range(10).where("id < 0"))
    draft.write("literally none", spark.range(10).limit(0))
    assert draft.rows() == {"some": 334, "none": 0, "literally none": 0}


LAYERS = ("bronze", "silver", "gold", "gold_features", "features", "labels")


def test_a_refresh_killed_between_any_two_writes_leaves_one_day(spark, tmp_path, monkeypatch):
    csv, n = feed(tmp_path / "feed.csv")
    longer = tmp_path / "longer.csv"
    lines = open(csv).read().splitlines()
    more = [line.replace("2026-0", "2027-0").replace("t", "u", 1) for line in lines[1:]]
    longer.write_text("\n".join([*lines, *more]) + "\n")
    tables = s.Tables.under(str(tmp_path / "tables"))
    refresh(spark, csv, tables)

    def state():
        found = read_tables(spark, [getattr(tables, name) for name in LAYERS])
        return [t.count() for t in found]

    before, write = state(), Draft.write
    assert before == [n, 240, 240, 240, 240, 240]
    kept = rows(read_table(spark, tables.features))
    stopped = 0
    while True:
        calls = []

        def stops(self, name, *rest, **more):
            calls.append(name)
            if len(calls) > stopped:
                raise KeyboardInterrupt
            return write(self, name, *rest, **more)

        monkeypatch.setattr(refresh_plan.Draft, "write", stops)
        try:
            refresh(spark, str(longer), tables)
        except KeyboardInterrupt:
            assert state() == before
            stopped += 1
            continue
        break
    assert stopped == 7  # the six layers and the rows per day
    assert rows(read_table(spark, tables.features)) != kept
    assert state() == [2 * n, 480, 480, 480, 480, 480]


def test_a_commit_that_fails_leaves_the_old_day(spark, tmp_path, monkeypatch):
    csv, _ = feed(tmp_path / "feed.csv")
    tables = s.Tables.under(str(tmp_path / "tables"))
    refresh(spark, csv, tables, lean=True)
    number = Snapshots(spark, str(tmp_path / "tables")).current()["commit"]
    monkeypatch.setattr(CommitLog, "_publish", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh(spark, csv, tables, lean=True)
    assert Snapshots(spark, str(tmp_path / "tables")).current()["commit"] == number
    assert read_table(spark, tables.labels).count() == 240


def test_an_interrupt_right_after_the_commit_deletes_nothing(spark, tmp_path, monkeypatch):
    csv, _ = feed(tmp_path / "feed.csv")
    tables = s.Tables.under(str(tmp_path / "tables"))
    publish = CommitLog._publish

    def interrupted(self, *rest):
        publish(self, *rest)
        raise KeyboardInterrupt

    monkeypatch.setattr(CommitLog, "_publish", interrupted)
    with pytest.raises(KeyboardInterrupt):
        refresh(spark, csv, tables, lean=True)
    assert read_table(spark, tables.labels).count() == 240


def test_features_and_labels_come_from_one_commit(spark, tmp_path):
    """Whoever resolved a commit goes on reading it while the next one is published."""
    csv, _ = feed(tmp_path / "feed.csv")
    tables = s.Tables.under(str(tmp_path / "tables"))
    refresh(spark, csv, tables, lean=True)
    labels, features = read_tables(spark, [tables.labels, tables.features])
    short = tmp_path / "short.csv"
    short.write_text("\n".join(open(csv).read().splitlines()[:40]) + "\n")
    refresh(spark, str(short), tables, lean=True)
    assert (labels.count(), features.count()) == (240, 240)
    assert read_table(spark, tables.labels).count() < 40


def test_split_from_kept_days_scans_only_days_with_a_cut(spark, tmp_path):
    csv, _ = feed(tmp_path / "feed.csv")
    tables = s.Tables.under(str(tmp_path / "tables"))
    refresh(spark, csv, tables)
    kept = build_dataset(spark, tables)
    plain = s.Tables.under(str(tmp_path / "plain"))
    for name in ("labels", "features"):
        write_table(read_table(spark, getattr(tables, name)), getattr(plain, name))
    counted = build_dataset(spark, plain)
    assert kept.split == counted.split and counted.profile is None
    assert rows(kept.rows) == rows(counted.rows)
    profile = {r["split"]: r["n_rows"] for r in kept.profile.collect()}
    assert profile == {"train": 153, "validation": 39, "test": 48}
    assert all(r["avg_unit_price_nulls"] == 0 for r in kept.profile.collect())


def test_kept_days_that_do_not_fit_are_an_error(spark, tmp_path):
    from demandloom.operators.chrono import fit_chrono_split, rows_per_day
    from pyspark.sql import functions as F

    days = spark.range(40).selectExpr("date_add(date'2026-01-01', cast(id div 4 as int)) AS d", "id")
    right = rows_per_day(days, "d")
    assert fit_chrono_split(days, ["d", "id"], per_day=right) == fit_chrono_split(days, ["d", "id"])
    wrong = right.withColumn("n_rows", F.col("n_rows") + 1)
    with pytest.raises(ValueError, match="do not fit"):
        fit_chrono_split(days, ["d", "id"], per_day=wrong)


def test_quarantine(spark, tmp_path):
    csv, n = feed(tmp_path / "feed.csv")
    dirty = tmp_path / "dirty.csv"
    dirty.write_text(open(csv).read() + "q1,not-a-date\nq2\n")
    tables = s.Tables.under(str(tmp_path / "tables"))
    counts = refresh(spark, str(dirty), tables, quarantine=True)
    assert counts["bronze"] == n + 2 and counts["quarantine"] == 2
    kept = read_table(spark, f"{tmp_path}/tables/quarantine")
    assert {r["malformed_row"] for r in kept.collect()} == {"q1,not-a-date", "q2"}
    assert "malformed_row" not in read_table(spark, tables.silver).columns
    with pytest.raises(ValueError, match="lean"):
        refresh(spark, csv, tables, lean=True, quarantine=True)
    refresh(spark, csv, tables)
    assert "quarantine" not in Snapshots(spark, f"{tmp_path}/tables").current()["tables"]

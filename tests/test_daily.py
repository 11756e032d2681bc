"""Daily refreshes against one full refresh of all feeds."""

import glob
import random

import pytest
from conftest import rows
from test_plans import NAMES

from demandloom import settings as s
from demandloom.plans import daily
from demandloom.plans.daily import refresh_daily
from demandloom.plans.dataset import build_dataset
from demandloom.plans.refresh import refresh
from demandloom.sources.snapshots import Snapshots
from demandloom.sources.tables import read_table

LAYERS = ("silver", "gold", "gold_features", "features", "labels")


def line(number, day, product="P1", city="Oslo", demand=1.0, price=2.0):
    cells = {
        "transaction_id": f"t{number}",
        "transaction_date": "" if day is None else f"2026-{1 + day // 28:02d}-{1 + day % 28:02d}",
        "product_name": product,
        "destination_city": city,
        "demand_quantity": str(demand),
        "unit_price_usd": str(price),
        "available_inventory": "3",
    }
    return ",".join(cells.get(n, "") for n in NAMES)


def some_lines(seed, days, start=0):
    draw = random.Random(seed)
    return [
        line(start + k, draw.choice(days), draw.choice("AB"), draw.choice(["Oslo", "Rome", ""]),
             draw.randrange(100) / 4, draw.randrange(1, 9))
        for k in range(120)
    ]


def write(path, lines):
    path.write_text("\n".join([",".join(NAMES), *lines]) + "\n")
    return str(path)


def same_as_full(spark, tmp_path, tables, feeds, exact=True):
    full = s.Tables.under(str(tmp_path / "full"))
    refresh(spark, write(tmp_path / "all.csv", [x for f in feeds for x in f]), full, exact=exact)
    for layer in LAYERS[1:]:
        one, two = (read_table(spark, getattr(t, layer)) for t in (tables, full))
        assert rows(one.select(two.columns)) == rows(two), layer
    used = read_table(spark, tables.silver)
    assert rows(used) == rows(read_table(spark, full.silver).select(used.columns))


def run(spark, tmp_path, feeds, **options):
    tables = s.Tables.under(str(tmp_path / "tables"))
    told = []
    for k, lines in enumerate(feeds):
        path = write(tmp_path / f"feed{k}.csv", lines)
        told.append(refresh_daily(spark, path, tables, exact=True, **options))
    return tables, told


def test_day_by_day(spark, tmp_path):
    feeds = [some_lines(k, [2 * k, 2 * k + 1], 1000 * k) for k in range(4)]
    tables, told = run(spark, tmp_path, feeds)
    assert [t["segments_reopened"] for t in told] == [0, 0, 0, 0]
    assert [t["computed_after"] for t in told] == [None, "2026-01-02", "2026-01-04", "2026-01-06"]
    same_as_full(spark, tmp_path, tables, feeds)
    table = Snapshots(spark, str(tmp_path / "tables")).current()["tables"]["gold"]
    assert len(table["segments"]) == 4 and told[-1]["gold"] == sum(x["rows"] for x in table["segments"])
    # The rows per day are kept along, so that training finds its cuts from them.
    assert build_dataset(spark, tables).profile is not None


def test_late_and_repeated_rows_reopen_their_span(spark, tmp_path):
    feeds = [some_lines(k, [2 * k, 2 * k + 1], 1000 * k) for k in range(4)]
    late = [line(9000, 3, "A", "Rome", 50.25), line(9001, 4, "new", "Oslo", 7.0)]
    feeds.append([*some_lines(9, [8], 5000), *late, *feeds[2][:20]])
    tables, told = run(spark, tmp_path, feeds)
    assert (told[-1]["computed_after"], told[-1]["segments_reopened"]) == ("2026-01-02", 3)
    same_as_full(spark, tmp_path, tables, feeds)


def test_rows_before_all_kept_states_and_rows_without_a_date(spark, tmp_path):
    feeds = [some_lines(k, [2 * k, 2 * k + 1], 1000 * k) for k in range(4)]
    feeds.append([line(9000, 0, "A", "Rome", 50.25)])
    feeds.append([line(9100, None, "A", "Rome", 1.0), line(9101, 9, "A", "Rome", 2.0)])
    feeds.append([line(9200, 10, "A", "Rome", 4.0)])
    tables, told = run(spark, tmp_path, feeds, kept_states=1)
    assert [t["computed_after"] for t in told[4:]] == [None, None, "2026-01-10"]
    same_as_full(spark, tmp_path, tables, feeds)


def test_an_empty_feed_changes_nothing(spark, tmp_path):
    feeds = [some_lines(0, [0, 1]), []]
    tables, told = run(spark, tmp_path, feeds)
    assert told[1]["gold"] == told[0]["gold"]
    assert Snapshots(spark, str(tmp_path / "tables")).current()["commit"] == 1


def test_daily_after_full_and_full_after_daily(spark, tmp_path):
    tables = s.Tables.under(str(tmp_path / "tables"))
    first, second, third = (some_lines(k, [2 * k, 2 * k + 1], 1000 * k) for k in range(3))
    refresh(spark, write(tmp_path / "a.csv", first), tables, exact=True)
    told = refresh_daily(spark, write(tmp_path / "b.csv", second), tables, exact=True)
    assert told["segments_reopened"] == 1
    refresh_daily(spark, write(tmp_path / "c.csv", third), tables, exact=True)
    same_as_full(spark, tmp_path, tables, [first, second, third])
    assert refresh(spark, write(tmp_path / "a.csv", first), tables, lean=True, exact=True)["features"]
    with pytest.raises(ValueError, match="lean"):
        refresh_daily(spark, write(tmp_path / "b.csv", second), tables)


def test_colliding_keys_and_a_kill_leave_the_days_before(spark, tmp_path, monkeypatch):
    feeds = [some_lines(0, [0, 1])]
    tables, _ = run(spark, tmp_path, feeds)
    before = rows(read_table(spark, tables.features))
    bad = write(tmp_path / "bad.csv", [line("x", 5, "X", ""), line("y", 5, "", "X")])
    with pytest.raises(ValueError, match="not a key"):
        refresh_daily(spark, bad, tables)
    written = daily.Draft.write

    def stops(self, name, *rest, **more):
        if name == "labels":
            raise KeyboardInterrupt
        return written(self, name, *rest, **more)

    monkeypatch.setattr(daily.Draft, "write", stops)
    with pytest.raises(KeyboardInterrupt):
        refresh_daily(spark, write(tmp_path / "c.csv", some_lines(1, [2], 500)), tables)
    assert rows(read_table(spark, tables.features)) == before
    assert Snapshots(spark, str(tmp_path / "tables")).current()["commit"] == 1


def test_another_refresh_in_between(spark, tmp_path, monkeypatch):
    """The slower one starts again from what the faster one left."""
    feeds = [some_lines(k, [2 * k, 2 * k + 1], 1000 * k) for k in range(3)]
    tables, _ = run(spark, tmp_path, feeds[:1])
    slow, fast = (write(tmp_path / f"{n}.csv", f) for n, f in (("slow", feeds[2]), ("fast", feeds[1])))
    commit, once = Snapshots.commit, []

    def later(self, *rest, **more):
        if not once:
            once.append(True)
            refresh_daily(spark, fast, tables, exact=True)
        return commit(self, *rest, **more)

    monkeypatch.setattr(Snapshots, "commit", later)
    refresh_daily(spark, slow, tables, exact=True)
    same_as_full(spark, tmp_path, tables, feeds)


def test_daily_job(spark, tmp_path, capsys):
    from demandloom import jobs

    feeds = [some_lines(k, range(20 * k, 20 * k + 20), 1000 * k) for k in range(2)]
    root = str(tmp_path / "root")
    for k, lines in enumerate(feeds):
        path = write(tmp_path / f"f{k}.csv", lines)
        told = jobs.main(["daily", "--root", root, "--csv", path, "--exact"])
    assert told["computed_after"] is not None and told["segments_reopened"] == 0
    assert jobs.main(["train", "--root", root])["run_id"]
    assert jobs.main(["predict", "--root", root, "--threshold=-1e9"])["outcome"]["status"] == "promoted"
    for wrong in (["daily", "--database", "x", "--csv", "c"], ["daily", "--root", root]):
        with pytest.raises(SystemExit):
            jobs.main(wrong)


def test_query_writes_all_feeds_at_once_and_feeds_may_be_empty(spark, tmp_path):
    from demandloom.catalogue import inputs
    from demandloom.catalogue import queries as q
    from demandloom.session import shared_dir

    tables = {
        "region": "(0, 'R')",
        "nation": "(0, 'N', 0)",
        "customer": "(1, 'c', 0, 1.0, 'S')",
        "supplier": "(1, 's', 0, 1.0)",
        "part": "(1, 'p', 'B', 'T', 2, 9.5)",
        "orders": ", ".join(f"({i}, 1, 'O', 1.0, '1995-01-{1 + i % 9:02d}', 'P')" for i in range(30)),
        "lineitem": ", ".join(
            f"({i}, 1, 1, 1, {i}.0, 1.0, 0.0, 0.0, 'R', 'F', '1995-02-01')" for i in [*range(30), 3]
        ),
    }
    for name, values in tables.items():
        columns = inputs.TABLES[name].split(", ")
        cast = ", ".join(f"cast(col{i} as {c.split()[1]}) {c.split()[0]}" for i, c in enumerate(columns, 1))
        given = spark.sql(f"select {cast} from values {values}")
        given.write.parquet(str(tmp_path / f"{name}.parquet"))
    before = set(glob.glob(f"{shared_dir(spark)}/*"))
    got = q.QUERIES["refresh_daily"](spark, str(tmp_path))
    assert rows(got) == rows(q.QUERIES["refresh_features_lean"](spark, str(tmp_path)))
    assert got.count() == 9 and spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    made = {f.rsplit("/", 1)[1].split("-")[0] for f in set(glob.glob(f"{shared_dir(spark)}/*")) - before}
    assert "feed" not in made

import json
import math
import random
from dataclasses import replace

import pytest
from conftest import rows

from demandloom import jobs
from demandloom import settings as s
from demandloom.plans.dataset import build_dataset
from demandloom.plans.modelbook import ModelBook
from demandloom.plans.refresh import keyed_features, lean_silver, refresh, silver
from demandloom.plans.select import select
from demandloom.plans.serve import serve
from demandloom.plans.train import train
from demandloom.sources.files import read_csv
from demandloom.sources.schemas import TRANSACTIONS_DDL, transactions_schema
from demandloom.sources.tables import read_table

NAMES = [line.split()[0] for line in TRANSACTIONS_DDL.strip().splitlines()]
SMALL_TREE = s.TreeSpec(max_depth=4, min_leaf=3, max_bins=32)
OPEN = s.Lifecycle(threshold=float("-inf"))


def feed(path, repeats=7):
    """Two products, two cities, 60 days; demand follows price; every 7th row comes twice."""
    rng = random.Random(5)
    lines = [",".join(NAMES)]
    for day in range(60):
        date = f"2026-{1 + day // 28:02d}-{1 + day % 28:02d}"
        for product in ("P1", "P2"):
            for city in ("Oslo", "Rome"):
                price = rng.randint(1, 9)
                cells = {
                    "transaction_id": f"t{len(lines)}",
                    "transaction_date": date,
                    "product_name": product,
                    "destination_city": city,
                    "demand_quantity": str(price * 10 + (5 if city == "Rome" else 0)),
                    "available_inventory": str(rng.randint(0, 50)),
                    "unit_price_usd": str(price),
                    "source_system": "erp",
                }
                line = ",".join(cells.get(n, "") for n in NAMES)
                lines += [line] * (2 if len(lines) % repeats == 0 else 1)
    path.write_text("\n".join(lines) + "\n")
    return str(path), len(lines) - 1


@pytest.fixture(scope="module")
def refreshed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("plan")
    csv, n = feed(folder / "feed.csv")
    tables = s.Tables.under(str(folder / "tables"))
    return csv, n, tables, refresh(spark, csv, tables)


def book_at(spark, tmp_path):
    return ModelBook(spark, str(tmp_path / "models"))


def test_layers(spark, refreshed):
    _, n, tables, counts = refreshed
    assert counts == {"bronze": n, "silver": 240, "gold": 240, "features": 240, "labels": 240}
    assert len(read_table(spark, tables.bronze).columns) == 34
    silver = read_table(spark, tables.silver)
    assert len(silver.columns) == 31 and "source_system" not in silver.columns
    gold = read_table(spark, tables.gold)
    assert gold.selectExpr("sum(transaction_count)").first()[0] == silver.count()
    assert tuple(read_table(spark, tables.features).columns) == s.FEATURES
    assert tuple(read_table(spark, tables.labels).columns) == s.LABELS


def test_two_refreshes_give_identical_tables(spark, refreshed, tmp_path):
    csv, _, tables, _ = refreshed
    again = s.Tables.under(str(tmp_path))
    refresh(spark, csv, again)
    for layer in ("gold", "features", "labels"):
        one, two = (read_table(spark, getattr(t, layer)) for t in (tables, again))
        assert rows(one) == rows(two)


def test_lean_refresh_gives_the_same_tables(spark, refreshed, tmp_path):
    csv, _, tables, _ = refreshed
    lean = s.Tables.under(str(tmp_path / "lean"))
    assert refresh(spark, csv, lean, lean=True) == {"features": 240, "labels": 240}
    for layer in ("features", "labels"):
        one, two = (read_table(spark, getattr(t, layer)) for t in (tables, lean))
        assert rows(one) == rows(two)
    assert not (tmp_path / "lean" / "bronze").exists()


def test_lean_and_full_agree_on_conflicting_rows(spark):
    schema = transactions_schema()
    names = schema.fieldNames()
    conflicting = [
        {"transaction_id": "t", "demand_quantity": d, "unit_price_usd": p, "supplier_name": n}
        for d, p, n in [(3.0, 1.0, "a"), (2.0, 5.0, "z"), (2.0, 4.0, "y"), (None, 9.0, "b")]
    ]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in conflicting], schema)
    full, lean = silver(df), lean_silver(df)
    assert rows(full.select(*lean.columns)) == rows(lean)
    assert lean.count() == 1


def test_rows_without_date_product_or_city_are_kept(spark, refreshed, tmp_path):
    csv, *_ = refreshed
    blank = "," * (len(NAMES) - 1)
    dirty = tmp_path / "dirty.csv"
    with open(csv) as feed_file:
        text = feed_file.read()
    dirty.write_text(text + "x1" + blank + "\nx2" + blank + "\nx3,not-a-date" + blank[1:] + "\n")
    tables, book = s.Tables.under(str(tmp_path)), book_at(spark, tmp_path)
    assert refresh(spark, str(dirty), tables, lean=True)["features"] == 241
    unknown = read_table(spark, tables.features).where("primary_key = ''").first()
    assert (unknown["transaction_count"], unknown["avg_unit_price"]) == (3, None)
    labels = read_table(spark, tables.labels).where("primary_key = ''").first()
    assert labels["total_demand"] is None
    train(build_dataset(spark, tables), book, OPEN, SMALL_TREE)
    assert book.runs().first()["validation_r2"] > 0.5


def test_lean_refresh_parses_only_seven_columns(spark, refreshed):
    csv, *_ = refreshed
    df = keyed_features(lean_silver(read_csv(spark, csv, transactions_schema())))
    scan = df._jdf.queryExecution().sparkPlan().collectLeaves().apply(0)
    assert set(scan.requiredSchema().fieldNames()) == {s.SOURCE_KEY, *s.USED}


def test_refresh_into_bucketed_catalog_tables(spark, refreshed, tmp_path):
    csv, *_ = refreshed
    spark.sql("create database if not exists demand")
    names = {f: f"demand.{f}" for f in s.Tables.__dataclass_fields__}
    tables = s.Tables(**{**names, "models": str(tmp_path / "models")})
    counts = refresh(
        spark, csv, tables, buckets=4, tags={"owner": "o'neil"}, description="Made for a test"
    )
    assert counts["features"] == 240
    properties = dict(map(tuple, spark.sql(f"show tblproperties {tables.features}").collect()))
    assert properties["primary_key"] == "primary_key"
    assert properties["tag.owner"] == "o'neil"
    assert spark.catalog.getTable(tables.features).description == "Made for a test"
    assert sum(build_dataset(spark, tables).split.sizes) == 240


def test_train_select_serve(spark, refreshed, tmp_path):
    *_, tables, _ = refreshed
    tables = replace(tables, predictions=str(tmp_path / "predictions"))
    data, book = build_dataset(spark, tables), book_at(spark, tmp_path)
    assert data.split.sizes == (153, 39, 48)

    # Nothing trained yet.
    with pytest.raises(ValueError, match="no finished run"):
        select(data, book)

    first = train(data, book, s.Lifecycle(tags={"team": "demand"}), SMALL_TREE)
    run = book.runs().first()
    assert run["run_id"] == first and run["status"] == "FINISHED"
    assert run["params"] == {"max_depth": "4", "min_leaf": "3", "max_bins": "32", "seed": "42"}
    assert run["tags"] == {"team": "demand"}
    assert run["validation_r2"] > 0.5 and run["validation_rmse"] >= run["validation_mae"] > 0

    # A gate nobody passes: no version, no challenger, nothing published.
    rejected = select(data, book, s.Lifecycle(threshold=1.0))
    assert (rejected.status, rejected.version) == ("rejected", None)
    assert serve(data, book, tables, OPEN).status == "no_challenger"
    assert book.versions().count() == 0

    # First model: no champion, so promoted without comparison.
    selection = select(data, book, OPEN)
    assert (selection.status, selection.version, selection.run_id) == ("registered", 1, first)
    outcome = serve(data, book, tables, OPEN)
    assert (outcome.status, outcome.champion_r2) == ("promoted", None)
    assert outcome.challenger_r2 == pytest.approx(selection.test_r2)
    assert book.holder(OPEN.model_name, OPEN.champion)["version"] == 1

    predictions = read_table(spark, tables.predictions)
    assert predictions.columns == [*s.FEATURES, "actual_demand", "predicted_demand", "timestamp"]
    assert predictions.count() == 48
    assert predictions.select("timestamp").distinct().count() == 1

    # The same version in both roles is kept, since it is not better than itself.
    again = serve(data, book, tables, OPEN)
    assert (again.status, again.champion_r2) == ("kept", again.challenger_r2)

    # A worse model (a single leaf) is trained later, but the best run is still the first.
    train(data, book, OPEN, s.TreeSpec(max_depth=0, min_leaf=3))
    assert select(data, book, OPEN).run_id == first
    assert serve(data, book, tables, OPEN).status == "kept"
    assert book.versions().count() == 2

    # A champion that cannot be loaded is an error, not an absent champion.
    broken = book.versions().first().asDict()
    book._append(
        "model_versions",
        "model_name string, version bigint, run_id string, model_path string, "
        "registered_at timestamp",
        {**broken, "version": 99, "model_path": str(tmp_path / "gone")},
    )
    book.assign(OPEN.model_name, OPEN.champion, 99, {})
    with pytest.raises(Exception, match="gone"):
        serve(data, book, tables, OPEN)
    book.assign(OPEN.model_name, OPEN.champion, 12345, {})
    with pytest.raises(ValueError, match="12345"):
        serve(data, book, tables, OPEN)


def test_better_challenger_replaces_champion(spark, refreshed, tmp_path):
    *_, tables, _ = refreshed
    tables = replace(tables, predictions=str(tmp_path / "predictions"))
    data, book = build_dataset(spark, tables), book_at(spark, tmp_path)
    train(data, book, OPEN, s.TreeSpec(max_depth=0, min_leaf=3))
    select(data, book, OPEN)
    assert serve(data, book, tables, OPEN).status == "promoted"
    train(data, book, OPEN, SMALL_TREE)
    select(data, book, OPEN)
    outcome = serve(data, book, tables, OPEN)
    assert outcome.status == "promoted" and outcome.challenger_version == 2
    assert outcome.challenger_r2 > outcome.champion_r2
    champion = book.holder(OPEN.model_name, OPEN.champion)
    assert champion["version"] == 2
    tags = {
        r["alias"]: r["tags"] for r in book.aliases().orderBy("assigned_at").collect()
    }
    assert tags["Champion"]["metric_r2_passed"] == "True"
    assert math.isclose(float(tags["Challenger"]["champion_r2"]), outcome.champion_r2)
    current = {r["version"]: r["tags"] for r in book.tags(OPEN.model_name).collect()}
    assert current[2]["test_r2_status"] == "cleared"
    assert current[2]["metric_r2_passed"] == "True"


def test_vocabulary_comes_from_the_train_split_only(spark, refreshed, tmp_path):
    from pyspark.sql import functions as F

    from demandloom.plans.dataset import split_dataset
    from demandloom.session import materialize

    *_, tables, _ = refreshed
    rows_ = build_dataset(spark, tables).rows
    late = rows_.withColumn(
        "destination_city",
        F.when(F.col("transaction_date") > "2026-02-26", "Late").otherwise(
            F.col("destination_city")
        ),
    )
    data, book = split_dataset(materialize(late, "late")), book_at(spark, tmp_path)
    train(data, book, OPEN, SMALL_TREE)
    products, cities = book.load(book.runs().first()).stages[:2]
    assert [list(products.labels), list(cities.labels)] == [["P1", "P2"], ["Oslo", "Rome"]]
    assert select(data, book, OPEN).status == "registered"


def test_jobs(spark, refreshed, tmp_path, capsys):
    csv, n, *_ = refreshed
    root = str(tmp_path / "root")
    assert jobs.main(["refresh", "--root", root, "--csv", csv])["bronze"] == n
    assert jobs.main(["train", "--root", root])["run_id"]
    result = jobs.main(["predict", "--root", root, "--threshold=-1e9"])
    assert result["outcome"]["status"] == "promoted"
    assert json.loads(capsys.readouterr().out.splitlines()[-1]) == result
    with pytest.raises(SystemExit):
        jobs.main(["refresh", "--root", root])


def test_test_rows_are_read_and_scored_once(spark, refreshed, tmp_path, monkeypatch):
    from demandloom.plans import dataset

    *_, tables, _ = refreshed
    tables = replace(tables, predictions=str(tmp_path / "predictions"))
    book = book_at(spark, tmp_path)
    passes = []
    kept = dataset.ChronoSplit.take

    def take(self, df, split):
        passes.append(split)
        return kept(self, df, split)

    monkeypatch.setattr(dataset.ChronoSplit, "take", take)
    folder = str(tmp_path / "set")
    with build_dataset(spark, tables, path=folder) as data:
        train(data, book, OPEN, s.TreeSpec(max_depth=0, min_leaf=3))
        select(data, book, OPEN)
        serve(data, book, tables, OPEN)
        train(data, book, OPEN, SMALL_TREE)
    assert not (tmp_path / "set").exists()
    with build_dataset(spark, tables) as data:
        passes.clear()
        select(data, book, OPEN)
        outcome = serve(data, book, tables, OPEN)
        assert passes == ["test"] and len(data._scratch) == 1
    assert outcome.status == "promoted" and outcome.champion_r2 is not None
    assert read_table(spark, tables.predictions).count() == 48


def test_a_refresh_between_train_and_predict_moves_nothing(spark, refreshed, tmp_path, capsys):
    csv, *_ = refreshed
    root = str(tmp_path / "root")
    jobs.main(["refresh", "--root", root, "--csv", csv, "--lean"])
    jobs.main(["train", "--root", root])
    longer = tmp_path / "longer.csv"
    with open(csv) as feed_file:
        lines = feed_file.read().splitlines()
    more = [line.replace("2026-0", "2027-0").replace("t", "u", 1) for line in lines[1:]]
    longer.write_text("\n".join([*lines, *more]) + "\n")
    assert jobs.main(["refresh", "--root", root, "--csv", str(longer), "--lean"])["labels"] == 480
    jobs.main(["predict", "--root", root, "--threshold=-1e9"])
    predictions = read_table(spark, s.Tables.under(root).predictions)
    assert predictions.count() == 48
    assert predictions.where("transaction_date >= '2027-01-01'").count() == 0


def test_rejected_candidate_sets_off_no_comparison(spark, refreshed, tmp_path, capsys):
    csv, *_ = refreshed
    root = str(tmp_path / "root")
    jobs.main(["refresh", "--root", root, "--csv", csv, "--lean"])
    jobs.main(["train", "--root", root])
    book = ModelBook(spark, s.Tables.under(root).models)
    data = book.dataset()
    assert select(data, book, OPEN).status == "registered"
    result = jobs.main(["predict", "--root", root, "--threshold=2"])
    assert result["selection"]["status"] == "rejected"
    assert result["outcome"]["status"] == "not_compared"
    assert book.holder(OPEN.model_name, OPEN.champion) is None


def test_jobs_on_catalog_tables(spark, refreshed, tmp_path, capsys):
    csv, *_ = refreshed
    spark.sql("create database if not exists jobs_demand")
    at = ["--database", "jobs_demand", "--artifacts", str(tmp_path / "artifacts")]
    counts = jobs.main(
        ["refresh", "--database", "jobs_demand", "--csv", csv, "--lean", "--exact"]
        + ["--buckets", "4", "--tag", "owner=team", "--description", "Daily demand"]
    )
    assert counts == {"features": 240, "labels": 240}
    table = spark.catalog.getTable("jobs_demand.features")
    assert table.description == "Daily demand"
    properties = dict(map(tuple, spark.sql("show tblproperties jobs_demand.features").collect()))
    assert properties["tag.owner"] == "team" and properties["primary_key"] == "primary_key"
    jobs.main(["train", *at])
    assert jobs.main(["predict", *at, "--threshold=-1e9"])["outcome"]["status"] == "promoted"
    assert spark.table("jobs_demand.models_model_runs").count() == 1
    assert spark.table("jobs_demand.predictions").count() == 48
    for wrong in (["train"], ["train", "--database", "x"], ["train", "--root", "r", *at]):
        with pytest.raises(SystemExit):
            jobs.main(wrong)
    with pytest.raises(ValueError, match="artifacts"):
        ModelBook(spark, "db.models")


def test_colliding_keys_leave_every_table_as_it_was(spark, refreshed, tmp_path):
    csv, *_ = refreshed
    tables = s.Tables.under(str(tmp_path / "tables"))
    refresh(spark, csv, tables)
    before = {f: rows(read_table(spark, getattr(tables, f))) for f in ("silver", "features")}
    with open(csv) as feed_file:
        lines = feed_file.read().splitlines()

    def line(**cells):
        return ",".join(cells.get(n, "") for n in NAMES)

    day = "2026-01-05"
    colliding = [
        line(transaction_id="c1", transaction_date=day, product_name="X"),
        line(transaction_id="c2", transaction_date=day, destination_city="X"),
    ]
    bad = tmp_path / "bad.csv"
    bad.write_text("\n".join([*lines, *colliding]) + "\n")
    for lean in (False, True):
        with pytest.raises(ValueError, match="is not a key"):
            refresh(spark, str(bad), tables, lean=lean)
    for layer, content in before.items():
        assert rows(read_table(spark, getattr(tables, layer))) == content


def test_cells_that_are_no_finite_number_are_missing(spark, refreshed, tmp_path):
    """One such label in the test period must not open the gate."""
    csv, *_ = refreshed
    with open(csv) as feed_file:
        lines = feed_file.read().splitlines()
    at = NAMES.index("demand_quantity")
    for i, odd in ((-1, "NaN"), (-2, "Infinity"), (-9, "-Infinity"), (5, "NaN")):
        cells = lines[i].split(",")
        cells[at] = odd
        lines[i] = ",".join(cells)
    odd_feed = tmp_path / "odd.csv"
    odd_feed.write_text("\n".join(lines) + "\n")
    tables, book = s.Tables.under(str(tmp_path)), book_at(spark, tmp_path)
    refresh(spark, str(odd_feed), tables, lean=True)
    labels = read_table(spark, tables.labels)
    assert labels.where("isnan(total_demand) or abs(total_demand) = double('inf')").count() == 0
    data = build_dataset(spark, tables)
    train(data, book, OPEN, s.TreeSpec(max_depth=0, min_leaf=3))
    assert select(data, book, s.Lifecycle(threshold=0.9)).status == "rejected"


def test_wide_rows_are_sorted_in_parts(spark, refreshed, tmp_path, monkeypatch):
    from demandloom.plans import refresh as module

    csv, n, _, _ = refreshed
    monkeypatch.setattr(module, "FILE_ROWS", 50)
    seen = []
    silver_of = module.silver
    monkeypatch.setattr(
        module,
        "silver",
        lambda df: seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes")) or silver_of(df),
    )
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    tables = s.Tables.under(str(tmp_path / "tables"))
    refresh(spark, csv, tables)
    assert len(read_table(spark, tables.bronze).inputFiles()) >= n / 50
    assert seen == ["16m"] and spark.conf.get("spark.sql.files.maxPartitionBytes") == before

"""The split training set: written once per training run and read again to predict."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from demandloom import settings as s
from demandloom.operators.chrono import SPLITS, ChronoSplit, fit_chrono_split, write_profiled
from demandloom.operators.encode import require_columns
from demandloom.operators.keyed import lookup_features
from demandloom.operators.trees import score
from demandloom.session import ONE_USE, scratch_path, settings
from demandloom.sources.snapshots import locate
from demandloom.sources.tables import beside, committed, read_tables, remove_path, split_path

# Rows per day of the features, a table beside them: what the split is found from.
DAYS = "days"
# The key alone can collide; with the series columns the order is total.
ORDER = (s.TIME, s.KEY, *s.SERIES)


@dataclass
class Dataset:
    """Joined rows in a written table, and the cut points of the chronological split.

    ``profile`` has rows and NULLs per split where the write counted them.
    ``path`` is the folder of the rows if this object owns it; ``close``, or leaving a
    ``with`` block, deletes it and what was scored on it.
    """

    rows: DataFrame
    split: ChronoSplit
    path: str | None = None
    profile: DataFrame | None = None
    _scored: dict[str, str] = field(default_factory=dict)
    _test: DataFrame | None = None
    _scratch: list[str] = field(default_factory=list)

    def part(self, name: str) -> DataFrame:
        return self.split.take(self.rows, name)

    def scored(self, models: dict[str, object]) -> tuple[DataFrame, dict[str, str]]:
        """The test rows with one prediction column per model, and which is whose.

        ``models`` maps a name that stays the model's own, as its path, to the model.
        Rows are read and scored once and written; a model asked for again costs
        nothing, a new one one more pass that keeps the columns there are.
        """
        new = {name: model for name, model in models.items() if name not in self._scored}
        if new:
            frame = self.part("test") if self._test is None else self._test
            for name, model in new.items():
                column = f"prediction_{len(self._scored)}"
                renamed = model.copy({model.stages[-1].predictionCol: column})
                frame = score(renamed, frame, column)
                self._scored[name] = column
            folder = scratch_path(frame.sparkSession, "scored")
            with settings(frame.sparkSession, ONE_USE):
                frame.write.parquet(folder)
            self._scratch.append(folder)
            self._test = frame.sparkSession.read.schema(frame.schema).parquet(folder)
        return self._test, {name: self._scored[name] for name in models}

    def close(self) -> None:
        spark = self.rows.sparkSession
        for folder in (*self._scratch, *([self.path] if self.path else [])):
            remove_path(spark, folder)
        self._scratch, self._scored, self._test = [], {}, None

    def __enter__(self) -> "Dataset":
        return self

    def __exit__(self, *_) -> None:
        self.close()


def training_set(spark: SparkSession, tables: s.Tables, fmt: str = "parquet") -> DataFrame:
    """Labels with their features, both as one commit left them."""
    labels, features = read_tables(spark, [tables.labels, tables.features], fmt)
    return lookup_features(labels, features, s.KEY)


def build_dataset(
    spark: SparkSession, tables: s.Tables, fmt: str = "parquet", path: str | None = None
) -> Dataset:
    """The joined rows written to ``path``, a scratch folder by default, and their split.

    Where the refresh has kept the rows per day in the same commit, the cuts are found
    from them, and only the days that hold one are scanned. The write then counts rows and
    NULLs per split: ``profile``.
    """
    path = path or scratch_path(spark, "training-set")
    days = beside(tables.features, DAYS)
    covered = committed(days, fmt) and locate(spark, [tables.labels, tables.features, days])
    refs = [tables.labels, tables.features]
    kept = covered and covered[days] != [days] and split_path(tables.labels)[0] == split_path(days)[0]
    labels, features, *per_day = read_tables(spark, [*refs, days] if kept else refs, fmt)
    joined = lookup_features(labels, features, s.KEY)
    if not kept:
        with settings(spark, ONE_USE):
            joined.write.parquet(path)
        data = split_dataset(spark.read.schema(joined.schema).parquet(path))
        data.path = path
        return data
    split = fit_chrono_split(features, ORDER, s.HELD_OUT, *per_day)
    rows, profile = write_profiled(joined, split, joined.columns, path)
    found = {r["split"]: r["n_rows"] for r in profile.collect()}
    if tuple(found.get(name, 0) for name in SPLITS) != split.sizes:
        raise ValueError(f"rows per split are {found}, by the kept rows per day {split.sizes}")
    return Dataset(rows, split, path, profile)


def split_dataset(written: DataFrame, per_day: DataFrame | None = None) -> Dataset:
    require_columns(written, ORDER)
    return Dataset(written, fit_chrono_split(written, ORDER, s.HELD_OUT, per_day))


# The record of a written data set: what it takes to open it again, cut points included.
RECORD = (
    "path string, order array<string>, types array<string>, sizes array<bigint>, "
    "train_last array<string>, validation_last array<string>, schema string, "
    "created_at timestamp, commit bigint"
)


def as_record(data: Dataset) -> dict:
    split = data.split
    return {
        "path": data.path,
        "order": list(split.order),
        "types": list(split.types),
        "sizes": list(split.sizes),
        "train_last": split.train_last and list(split.train_last),
        "validation_last": split.validation_last and list(split.validation_last),
        "schema": data.rows.schema.json(),
    }


def from_record(spark: SparkSession, record: Row) -> Dataset:
    """The rows and cut points as they were when recorded, without another look at the tables."""
    import json

    from pyspark.sql.types import StructType

    def last(values):
        return None if values is None else tuple(values)

    split = ChronoSplit(
        tuple(record["order"]),
        tuple(record["types"]),
        tuple(record["sizes"]),
        last(record["train_last"]),
        last(record["validation_last"]),
    )
    schema = StructType.fromJson(json.loads(record["schema"]))
    return Dataset(spark.read.schema(schema).parquet(record["path"]), split)

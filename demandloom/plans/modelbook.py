"""State of the model lifecycle: append-only logs and a folder of models.

Every entry of a log is a commit of its own: jobs that register or assign at the same time
get different numbers, and the order of the numbers is the order of events, whatever the
clocks of the drivers say.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType

from demandloom.operators import lifecycle as lc
from demandloom.operators.trees import load_model, save_model
from demandloom.plans.dataset import RECORD, Dataset, as_record, from_record
from demandloom.sources.commits import CommitLog
from demandloom.sources.tables import is_path, remove_path


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _as_json(value):
    return value.isoformat() if isinstance(value, datetime) else value


@dataclass(frozen=True)
class ModelBook:
    """Reads and appends the lifecycle logs.

    ``root`` is a folder on shared storage, or the beginning of catalog names, as
    ``db.models`` for ``db.models_model_runs``; ``artifacts`` is the folder of models
    and data sets, by default below a ``root`` that is a folder. A log is a folder of JSON
    entries below ``root``, or below ``artifacts`` and a catalog table over it.
    """

    spark: SparkSession
    root: str
    artifacts: str | None = None

    def __post_init__(self):
        if not is_path(self.root) and not self.artifacts:
            raise ValueError("catalog tables need a folder for the models: artifacts")

    def _log(self, name: str) -> CommitLog:
        folder = f"{self.root}/{name}" if is_path(self.root) else self.folder(f"logs/{name}")
        return CommitLog(self.spark, folder)

    def folder(self, name: str) -> str:
        return f"{self.artifacts or self.root + '/artifacts'}/{name}"

    def _append(self, name: str, ddl: str, row: dict | Callable[[], dict]) -> dict:
        """Publish a row, made anew from the logs as they are if another writer was faster."""
        log = self._log(name)
        fields = [f for f in StructType.fromDDL(ddl).fieldNames() if f != "commit"]

        def make(_: int) -> dict:
            values = row() if callable(row) else row
            return {f: _as_json(values[f]) for f in fields}

        entry = log.append(make)
        if not is_path(self.root):
            table = f"{self.root}_{name}"
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING json LOCATION '{log.folder}'")
            self.spark.catalog.refreshTable(table)
        return entry

    def _read(self, name: str, ddl: str) -> DataFrame:
        return self._log(name).frame(ddl)

    def runs(self) -> DataFrame:
        return self._read("model_runs", lc.RUNS)

    def versions(self) -> DataFrame:
        return self._read("model_versions", lc.VERSIONS)

    def aliases(self) -> DataFrame:
        return self._read("promotion_log", lc.ALIASES)

    def log_run(
        self,
        model: PipelineModel,
        run_name: str,
        params: dict[str, str],
        tags: dict[str, str],
        metrics: dict[str, float | None],
        started_at: datetime,
    ) -> str:
        """Save encoder and tree, then append the finished run. Returns the run id."""
        run_id = uuid.uuid4().hex
        path = save_model(model, self.folder(run_id))
        self._append(
            "model_runs",
            lc.RUNS,
            {
                "run_id": run_id,
                "run_name": run_name,
                "status": lc.FINISHED,
                "params": params,
                "tags": tags,
                "validation_mae": metrics["mae"],
                "validation_rmse": metrics["rmse"],
                "validation_r2": metrics["r2"],
                "model_path": path,
                "started_at": started_at,
            },
        )
        return run_id

    def register(self, model_name: str, run: Row) -> int:
        """A new version of ``model_name`` pointing at the run's model.

        Of two jobs that register at the same time the later one sees the other's version
        and takes the next number.
        """
        candidate = self.spark.createDataFrame(
            [(model_name, run["run_id"], run["model_path"])],
            "model_name string, run_id string, model_path string",
        )

        def row() -> dict:
            numbered = lc.next_versions(candidate, self.versions()).first()
            return {**numbered.asDict(), "registered_at": _now()}

        return self._append("model_versions", lc.VERSIONS, row)["version"]

    def assign(self, model_name: str, alias: str, version: int, tags: dict[str, str]) -> None:
        self._append(
            "promotion_log",
            lc.ALIASES,
            {
                "model_name": model_name,
                "alias": alias,
                "version": version,
                "tags": tags,
                "assigned_at": _now(),
            },
        )

    def new_dataset_path(self) -> str:
        return self.folder(f"datasets/{uuid.uuid4().hex}")

    def keep_dataset(self, data: Dataset) -> None:
        """Record ``data`` as the one to predict on; the folder of the last one goes."""
        before = self._latest_dataset()
        self._append("data_sets", RECORD, {**as_record(data), "created_at": _now()})
        if before is not None and before["path"] != data.path:
            remove_path(self.spark, before["path"])

    def dataset(self) -> Dataset:
        """The data set recorded last, with the cut points the models were trained on."""
        record = self._latest_dataset()
        if record is None:
            raise ValueError("no recorded data set: train first")
        return from_record(self.spark, record)

    def _latest_dataset(self) -> Row | None:
        return self._read("data_sets", RECORD).orderBy("commit", ascending=False).first()

    def tags(self, model_name: str) -> DataFrame:
        """``version, tags``: of each version the newest value of every tag it was ever given."""
        return lc.current_tags(self._of(self.aliases(), model_name), ["version"], ["commit"])

    def holder(self, model_name: str, alias: str, registered: bool = True) -> Row | None:
        """The version row behind an alias now, or None if the alias was never assigned.

        An alias of a version that is not there is an error, unless ``registered`` is off.
        """
        current = lc.current_aliases(self._of(self.aliases(), model_name), newest=["commit"])
        assigned = current.where(current["alias"] == alias).first()
        if assigned is None:
            return None
        versions = self._of(self.versions(), model_name)
        found = versions.where(versions["version"] == assigned["version"])
        if not registered:
            return found.first()
        return lc.require_row(
            found,
            f"{alias} points at version {assigned['version']}, which is not registered",
        )

    @staticmethod
    def _of(df: DataFrame, model_name: str) -> DataFrame:
        return df.where(df["model_name"] == model_name)

    def exists(self, row: Row) -> bool:
        """Whether the model of a row is still in its folder."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(row["model_path"])
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def load(self, row: Row) -> PipelineModel:
        """The model of a run or version row."""
        return load_model(row["model_path"])

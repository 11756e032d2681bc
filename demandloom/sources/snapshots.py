"""Tables below one folder that are replaced together, by one commit.

``<root>/_commits`` holds the commits, ``<root>/_data/<id>`` the files of one draft. A commit
lists the folders of every table it covers. Until then nobody sees a draft; after it every
reader does, and whoever resolved an earlier commit goes on reading that one.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from demandloom.session import ONE_USE, settings
from demandloom.sources.commits import CommitLog

COMMITS, DATA = "_commits", "_data"


class Draft:
    """Files of tables that are not committed yet."""

    def __init__(self, spark: SparkSession, root: str, log: CommitLog):
        self.spark, self.root, self.log = spark, root.rstrip("/"), log
        self.since = max(log.numbers(), default=0)
        self.folder = f"{DATA}/{uuid.uuid4().hex}"
        self.tables: dict[str, dict] = {}

    def write(
        self,
        name: str,
        df: DataFrame,
        fmt: str = "parquet",
        partition_by: Sequence[str] = (),
        options: Mapping[str, str] | None = None,
    ) -> DataFrame:
        """Write ``df`` as table ``name``; returns it as read back.

        Its rows are counted by the write itself and the number goes into the commit.
        """
        path = f"{self.folder}/{name}"
        counted = Observation()
        writer = df.observe(counted, F.count(F.lit(1)).alias("n")).write.format(fmt)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        with settings(self.spark, ONE_USE):
            writer.options(**(options or {})).save(f"{self.root}/{path}")
        self.tables[name] = {"paths": [path], "rows": counted.get["n"]}
        return self.read(name, fmt)

    def rows(self) -> dict[str, int]:
        return {name: table["rows"] for name, table in self.tables.items()}

    def read(self, name: str, fmt: str = "parquet") -> DataFrame:
        paths = [f"{self.root}/{p}" for p in self.tables[name]["paths"]]
        return self.spark.read.format(fmt).load(paths)

    def discard(self) -> None:
        """Delete the files, unless a commit has them: it may be published and yet have been
        interrupted before it returned."""
        later = (self.log.read(n) for n in self.log.numbers() if n > self.since)
        if not any(self.folder.split("/")[1] in _folders(commit) for commit in later):
            _remove(self.spark, f"{self.root}/{self.folder}")


class Snapshots:
    """Commits of the tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/{COMMITS}")

    def draft(self) -> Draft:
        return Draft(self.spark, self.root, self.log)

    def current(self) -> dict | None:
        return self.log.latest()

    def commit(
        self,
        draft: Draft,
        without: Sequence[str] = (),
        change: Callable[[dict], dict] | None = None,
        note: Mapping | None = None,
    ) -> dict:
        """Publish the tables of ``draft`` as the next commit.

        Tables of the commit before go on unless the draft has them or they are in
        ``without``. ``change`` may make the tables from those of the commit before instead,
        and raise if that is not one the draft fits.
        """

        def make(number: int) -> dict:
            before = self.log.read(number - 1) if number > 1 else {"tables": {}}
            kept = {n: t for n, t in before["tables"].items() if n not in without}
            return {
                "created_at": datetime.now(timezone.utc).isoformat(),
                "tables": change(before) if change else {**kept, **draft.tables},
                "note": dict(note or {}),
            }

        return self.log.append(make)

    def paths(self, name: str, commit: dict | None) -> list[str] | None:
        """Folders of a table in a commit, None if it does not cover that table."""
        table = (commit or {}).get("tables", {}).get(name)
        return None if table is None else [f"{self.root}/{p}" for p in table["paths"]]

    def expire(self, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
        """Delete what only commits before the last ``keep`` list, and drafts never committed.

        Of the latter those whose folder is unchanged for ``older_than`` seconds, since
        another writer may be at work. Returns the folders. Commits themselves stay.
        """
        numbers = self.log.numbers()
        kept = [self.log.read(n) for n in numbers[-keep:]]
        used = {folder for commit in kept for folder in _folders(commit)}
        # Older commits list nothing but these and what has gone before.
        listed = {folder for number in numbers[:-keep][-1:] for folder in _folders(self.log.read(number))}
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{DATA}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        gone = []
        for status in files.listStatus(path) if files.exists(path) else ():
            name, changed = status.getPath().getName(), status.getModificationTime() / 1000
            if name not in used and (name in listed or time.time() - changed > older_than):
                files.delete(status.getPath(), True)
                gone.append(name)
        return sorted(gone)


def _folders(commit: dict) -> set[str]:
    """Drafts that a commit needs, for its tables or for what is to be added to them."""
    paths = [p for t in commit["tables"].values() for p in t["paths"]]
    paths += [x["path"] for t in commit["tables"].values() for x in t.get("segments", [])]
    return {p.split("/")[1] for p in paths}


def locate(spark: SparkSession, refs: Sequence[str]) -> dict[str, list[str]]:
    """Folders to read for each path in ``refs``; paths below one root come from one commit.

    A path that no commit covers stands for itself.
    """
    found, commits = {}, {}
    for ref in refs:
        root, _, name = ref.rstrip("/").rpartition("/")
        if root not in commits:
            commits[root] = Snapshots(spark, root).current()
        paths = Snapshots(spark, root).paths(name, commits[root])
        found[ref] = [ref] if paths is None else paths
    return found


def _remove(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)

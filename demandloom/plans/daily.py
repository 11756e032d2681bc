"""Daily refresh: reads the new feed and the last facts of each series, not the history.

The tables grow by segments, each a span of days. At the end of a segment the last facts of
every series are kept, as many rows as the features look back: with them the next day's
features come out as if all facts had been read. Rows that come late reopen the segments
from their day on, and those only; everything is published by one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandloom import settings as s
from demandloom.operators.chrono import rows_per_day
from demandloom.operators.keyed import require_composite_key, split_xy
from demandloom.operators.refine import dedup_by_key
from demandloom.plans.dataset import DAYS
from demandloom.plans.refresh import INNER, gold, gold_features, keyed, lean_silver
from demandloom.sources.files import read_csv
from demandloom.sources.schemas import transactions_schema
from demandloom.sources.snapshots import Draft, Snapshots
from demandloom.sources.tables import committed, split_path

TAILS = "tails"
# Segment ends whose tails are kept: how many refreshes back a late row may fall before
# everything is computed anew.
KEPT_STATES = 30
# Facts of a series that its next features look back on.
REACH = max(*s.LAGS, s.ROLLING_ROWS)


class Superseded(RuntimeError):
    """Another refresh was committed while this one was at work."""


def tails(facts: DataFrame) -> DataFrame:
    """The last ``REACH`` facts of every series; a task sends no more than that of one."""
    newest = Window.partitionBy(*s.SERIES).orderBy(F.desc(s.TIME))
    ranked = facts.select(s.TIME, *s.SERIES, s.TARGET).withColumn("_back", F.row_number().over(newest))
    return ranked.where(F.col("_back") <= REACH).drop("_back")


def features_after(facts: DataFrame, before: DataFrame | None, exact: bool | str) -> DataFrame:
    """Features of ``facts``, whose series go on from the tails ``before``."""
    if before is None:
        return gold_features(facts, exact)
    both = facts.withColumn("_new", F.lit(True)).unionByName(
        before.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    return gold_features(both, exact).where("_new").drop("_new")


def refresh_daily(
    spark: SparkSession,
    csv_path: str,
    tables: s.Tables,
    exact: bool | str = False,
    kept_states: int = KEPT_STATES,
) -> dict:
    """Add a feed to the tables; features and labels are those of a full refresh of all feeds.

    An id that comes again has the date that it had before, so that its rows meet in a
    reopened segment. Rows without a date belong before all others and have everything
    computed anew, as has a row older than all kept states. Tables are plain parquet files
    by path below one root, as for a lean refresh with a silver layer of the columns
    that reach the facts. After a full refresh the first daily one reads its silver layer.

    Returns rows per layer, the days from which it computed and the number of segments
    reopened. A feed without rows changes nothing. If another refresh gets in between, this
    one starts again from what that left.
    """
    refs = {n: getattr(tables, n) for n in ("silver", "gold", "gold_features", "features", "labels")}
    roots = {split_path(ref)[0] for ref in refs.values()}
    if len(roots) != 1 or not all(committed(ref, "parquet") for ref in refs.values()):
        raise ValueError("a daily refresh needs paths below one root")
    names = {n: split_path(ref)[1] for n, ref in refs.items()}
    snapshots = Snapshots(spark, roots.pop())
    incoming = snapshots.draft()
    try:
        new = incoming.write("feed", lean_silver(read_csv(spark, csv_path, transactions_schema())))
        span = new.agg(
            F.min(s.TIME).cast("string").alias("first"), F.count_if(F.col(s.TIME).isNull()).alias("dateless")
        ).first()
        while True:
            before = snapshots.current()
            if not incoming.rows()["feed"]:
                return _summary(before, names, None, 0)
            first = None if span["dateless"] else span["first"]
            draft = snapshots.draft()
            try:
                return _add(snapshots, draft, before, new, first, names, exact, kept_states)
            except Superseded:
                draft.discard()
            except BaseException:
                draft.discard()
                raise
    finally:
        incoming.discard()


def _segments(table: dict | None) -> list[dict]:
    """Segments of a table, oldest first; a table without is one that ends nowhere."""
    if table is None:
        return []
    return table.get("segments") or [{"to": None, "path": p, "rows": None} for p in table["paths"]]


def _add(snapshots, draft: Draft, before, new, first, names, exact, kept_states) -> dict:
    spark, root = snapshots.spark, snapshots.root
    old = (before or {}).get("tables", {})
    if names["features"] in old and names["silver"] not in old:
        raise ValueError("the last refresh was lean and left no silver layer to go on from")
    states = [x for x in old.get(TAILS, {}).get("segments", []) if first and x["to"] < first]
    base = states[-1] if states else None

    def closed(segment: dict) -> bool:
        return base is not None and segment["to"] is not None and segment["to"] <= base["to"]

    reopened = [x["path"] for x in _segments(old.get(names["silver"])) if not closed(x)]
    rows = new
    if reopened:
        again = spark.read.parquet(*[f"{root}/{p}" for p in reopened]).select(new.columns)
        rows = dedup_by_key(new.unionByName(again), [s.SOURCE_KEY], s.USED)
    tail = spark.read.parquet(f"{root}/{base['path']}") if base else None
    facts = draft.write(names["gold"], gold(draft.write(names["silver"], rows), exact))
    features = draft.write(names["gold_features"], features_after(facts, tail, exact))
    require_composite_key(features, s.KEY, s.TIME, s.SERIES)
    x, y = split_xy(keyed(features), s.FEATURES, s.LABELS)
    draft.write(names["features"], x)
    draft.write(names["labels"], y)
    days = draft.write(DAYS, rows_per_day(features, s.TIME))
    last = days.agg(F.max("day").cast("string")).first()[0]
    ends = facts.select(s.TIME, *s.SERIES, s.TARGET)
    draft.write(TAILS, tails(ends if tail is None else ends.unionByName(tail)))

    def change(now: dict) -> dict:
        if now.get("commit") != (before or {}).get("commit"):
            raise Superseded
        merged = {n: t for n, t in now["tables"].items() if n not in INNER}
        for name, table in draft.tables.items():
            segments = [x for x in _segments(old.get(name)) if closed(x)]
            segments.append({"to": last, "path": table["paths"][0], "rows": table["rows"]})
            if name == TAILS:
                # Of the dateless rows' own segment there is no end to go on from.
                segments = [x for x in segments if x["to"]][-kept_states:]
            paths = [x["path"] for x in (segments[-1:] if name == TAILS else segments)]
            merged[name] = {"paths": paths, "segments": segments, "rows": sum(x["rows"] for x in segments)}
        return merged

    commit = snapshots.commit(draft, change=change)
    snapshots.expire()
    return _summary(commit, names, base and base["to"], len(reopened))


def _summary(commit: dict | None, names: dict, after: str | None, reopened: int) -> dict:
    found = (commit or {}).get("tables", {})
    rows = {n: found[name]["rows"] for n, name in names.items() if name in found}
    return {**rows, "computed_after": after, "segments_reopened": reopened}

"""Data refresh: feed to bronze, silver, facts, features, keyed feature and label tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandloom import settings as s
from demandloom.operators.chrono import rows_per_day
from demandloom.operators.facts import daily_facts
from demandloom.operators.keyed import fill_cold_start, require_composite_key, split_xy, with_key
from demandloom.operators.panel import series_features, with_calendar
from demandloom.operators.refine import dedup_by_key, drop_metadata, split_repeated
from demandloom.plans.dataset import DAYS
from demandloom.session import scratch_path, settings
from demandloom.sources.files import FILE_ROWS, read_csv, stamp_ingestion
from demandloom.sources.schemas import transactions_schema
from demandloom.sources.snapshots import Draft, Snapshots
from demandloom.sources.tables import (
    beside,
    committed,
    describe_table,
    is_path,
    split_path,
    write_table,
)

# Rows of the feed that do not fit the schema, as text.
QUARANTINE = "quarantine"
MALFORMED = "malformed_row"
# What of the bronze files one task reads to sort it.
SORTED_BYTES = "16m"
INNER = ("bronze", "silver", "gold", QUARANTINE)


def bronze(spark: SparkSession, csv_path: str, corrupt_column: str | None = None) -> DataFrame:
    schema = transactions_schema()
    return stamp_ingestion(read_csv(spark, csv_path, schema, corrupt_column=corrupt_column))


def silver(bronze_df: DataFrame) -> DataFrame:
    """Without metadata, one row per transaction.

    Of several rows with one id, the first by the columns that reach the facts
    stays, then by the rest. The ingestion stamp, one value per load, is left out.
    """
    cleaned = drop_metadata(bronze_df, s.METADATA)
    apart = (s.SOURCE_KEY, "ingested_at", *s.USED)
    rest = [c for c in cleaned.columns if c not in apart]
    return dedup_by_key(cleaned, [s.SOURCE_KEY], [*s.USED, *rest])


def silver_of_files(bronze_df: DataFrame) -> DataFrame:
    """``silver`` of a table of parquet files, where whole rows are exchanged only if their id may repeat."""
    alone, again = split_repeated(bronze_df, [s.SOURCE_KEY])
    return drop_metadata(alone, s.METADATA).unionByName(silver(again))


def lean_silver(bronze_df: DataFrame) -> DataFrame:
    """Key and the columns that reach the facts: the same values there as ``silver``.

    Only 7 of the 33 feed columns are parsed, sorted and shuffled.
    """
    return dedup_by_key(bronze_df.select(s.SOURCE_KEY, *s.USED), [s.SOURCE_KEY], s.USED)


def gold(silver_df: DataFrame, exact: bool | str = False) -> DataFrame:
    return daily_facts(silver_df, [s.TIME, *s.SERIES], s.MEASURES, exact)


def gold_features(gold_df: DataFrame, exact: bool | str = False) -> DataFrame:
    """Facts with lags, trailing mean and calendar columns.

    A fact has one row per series and date, so a series, hot or not, is never
    longer than the calendar.
    """
    featured = series_features(
        gold_df, s.TARGET, s.SERIES, [s.TIME], s.LAGS, s.ROLLING, s.ROLLING_ROWS, exact
    )
    return with_calendar(featured, s.TIME)


def keyed(features_df: DataFrame) -> DataFrame:
    """Cold start filled and the composite key added; still holds the label."""
    return with_key(fill_cold_start(features_df, s.COLD_START), s.KEY, s.TIME, s.SERIES)


def keyed_features(silver_df: DataFrame, exact: bool | str = False) -> DataFrame:
    """Silver to keyed features and label in one lazy plan, pruned to the columns it needs."""
    return keyed(gold_features(gold(silver_df, exact), exact))


def _bucketing(buckets: int | None) -> dict:
    return {"bucket_by": [s.KEY], "buckets": buckets} if buckets else {}


def refresh(
    spark: SparkSession,
    csv_path: str,
    tables: s.Tables,
    fmt: str = "parquet",
    buckets: int | None = None,
    tags: dict[str, str] | None = None,
    lean: bool = False,
    exact: bool | str = False,
    description: str | None = None,
    quarantine: bool = False,
) -> dict[str, int]:
    """Rebuild the tables; returns rows per layer written, as counted by the writes.

    All layers are written aside, each read by the next, so the feed is parsed once. Then
    the keys are audited on three columns of the features: two facts of one key, as a NULL
    product and a NULL city can make them, are an error that leaves every table as it was.
    Tables of plain files by path then change together, by one commit: readers see
    all of the old day or all of the new one, wherever this stops. Catalog tables, and
    formats that keep their own log, are overwritten one after the other at the end.

    ``lean`` goes from the feed to the features in one plan, without bronze, silver and
    gold tables, and gives the same features and labels; inner layers of an earlier
    refresh, being of another day, are then no longer there. ``quarantine`` keeps what does
    not fit the schema as text in a table of its own; it needs the bronze layer. ``buckets``
    stores features and labels bucketed on the key (catalog names only). ``exact`` sums in
    integer hundredths, or any doubles if it is ``"doubles"``.
    """
    if lean and quarantine:
        raise ValueError("quarantine needs the bronze layer, which a lean refresh leaves out")
    layers = [f for f in s.Tables.__dataclass_fields__ if f not in ("predictions", "models")]
    refs = {name: getattr(tables, name) for name in layers}
    places = {split_path(ref) for ref in refs.values() if committed(ref, fmt)}
    roots = {root for root, _ in places}
    one_root = len(places) == len(refs) and len(roots) == 1 and not buckets
    snapshots = Snapshots(spark, roots.pop() if one_root else scratch_path(spark, "refresh"))
    draft = snapshots.draft()
    names = {name: split_path(ref)[1] if one_root else name for name, ref in refs.items()}
    try:
        kind = fmt if one_root else "parquet"
        counts = _draft_layers(spark, csv_path, draft, names, kind, lean, exact, quarantine)
        if one_root:
            snapshots.commit(draft, without=[names.get(n, n) for n in INNER])
            snapshots.expire()
            return counts
        for name in draft.tables:
            bucketing = _bucketing(buckets) if name in ("features", "labels") else {}
            ref = refs.get(name, beside(tables.features, name))
            write_table(draft.read(name), ref, fmt, **bucketing)
        if not is_path(tables.features):
            describe_table(spark, tables.features, [s.KEY], description, tags)
    except BaseException:
        draft.discard()
        raise
    draft.discard()
    return counts


def _draft_layers(
    spark: SparkSession,
    csv_path: str,
    draft: Draft,
    names: dict[str, str],
    fmt: str,
    lean: bool,
    exact: bool | str,
    quarantine: bool,
) -> dict[str, int]:
    """Every layer written from the one before; rows of those that are products."""

    def write(name: str, df: DataFrame, options: dict | None = None) -> DataFrame:
        return draft.write(names.get(name, name), df, fmt, options=options)

    if lean:
        facts = gold(lean_silver(read_csv(spark, csv_path, transactions_schema())), exact)
    else:
        wide = {"compression": "zstd"} if fmt == "parquet" else {}
        fed = bronze(spark, csv_path, MALFORMED if quarantine else None)
        fed = write("bronze", fed, {**wide, "maxRecordsPerFile": FILE_ROWS})
        if quarantine:
            kept = fed.where(F.col(MALFORMED).isNotNull()).select(MALFORMED, "ingested_at")
            write(QUARANTINE, kept)
            fed = fed.drop(MALFORMED)
        # A task sorts whole rows, which are many times the size that they have in the files.
        with settings(spark, {"spark.sql.files.maxPartitionBytes": SORTED_BYTES}):
            kept = write("silver", silver_of_files(fed) if fmt == "parquet" else silver(fed), wide)
        facts = write("gold", gold(kept, exact))
    features = write("gold_features", gold_features(facts, exact))
    require_composite_key(features, s.KEY, s.TIME, s.SERIES)
    x, y = split_xy(keyed(features), s.FEATURES, s.LABELS)
    write("features", x)
    write("labels", y)
    write(DAYS, rows_per_day(features, s.TIME))
    products = [n for n in names if n != "gold_features"] + [QUARANTINE]
    rows = draft.rows()
    return {n: rows[names.get(n, n)] for n in products if names.get(n, n) in rows}

"""Model selection and promotion over append-only tables.

``model_runs`` has one row per training run, ``model_versions`` one per
registered version, ``promotion_log`` one per alias assignment. Nothing is
updated in place: the current state is a query over the log. ``commit`` is the number
of the row in its log, which says what came first where clocks may differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from demandloom.functions.exact import finite

# The three state tables, as DDL.
RUNS = (
    "run_id string, run_name string, status string, params map<string,string>, "
    "tags map<string,string>, validation_mae double, validation_rmse double, "
    "validation_r2 double, model_path string, started_at timestamp, commit bigint"
)
VERSIONS = (
    "model_name string, version bigint, run_id string, model_path string, "
    "registered_at timestamp, commit bigint"
)
ALIASES = (
    "model_name string, alias string, version bigint, tags map<string,string>, "
    "assigned_at timestamp, commit bigint"
)

FINISHED = "FINISHED"


def finished_runs(runs: DataFrame, run_name: str | None = None) -> DataFrame:
    """Completed runs, of one name if given."""
    done = runs.where(F.col("status") == FINISHED)
    return done if run_name is None else done.where(F.col("run_name") == run_name)


def best_run(
    runs: DataFrame,
    metric: str,
    run_name: str | None = None,
    recency: Sequence[str] = ("started_at",),
) -> DataFrame:
    """The completed run with the highest ``metric``: at most one row.

    Scores that are NULL, NaN or infinite come last; a tie goes to the latest run, then to the smallest id.
    """
    return (
        finished_runs(runs, run_name)
        .orderBy(finite(F.col(metric)).desc_nulls_last(), *[F.desc_nulls_last(c) for c in recency], "run_id")
        .limit(1)
    )


def require_row(df: DataFrame, message: str) -> Row:
    """The first row of a small result, or an error."""
    row = df.first()
    if row is None:
        raise ValueError(message)
    return row


def quality_gate(scores: DataFrame, metric: str, threshold: Column | float) -> DataFrame:
    """Add ``threshold`` and ``passed``: strictly above it.

    A score that is missing, NaN or infinite fails.
    """
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return scores.withColumns(
        {"threshold": limit, "passed": F.coalesce(finite(F.col(metric)) > limit, F.lit(False))}
    )


def next_versions(
    accepted: DataFrame,
    versions: DataFrame,
    model: str = "model_name",
    order: Sequence[str] = ("run_id",),
) -> DataFrame:
    """Number accepted runs per model, going on from the highest registered version."""
    last = versions.groupBy(model).agg(F.max("version").alias("_last"))
    window = Window.partitionBy(model).orderBy(*order)
    return (
        accepted.join(last, model, "left")
        .withColumn(
            "version",
            (F.coalesce(F.col("_last"), F.lit(0)) + F.row_number().over(window)).cast("bigint"),
        )
        .drop("_last")
    )


def current_aliases(
    log: DataFrame,
    by: Sequence[str] = ("model_name", "alias"),
    newest: Sequence[str] = ("assigned_at", "version"),
) -> DataFrame:
    """The newest assignment per model and alias; one candidate row per task is shuffled."""
    window = Window.partitionBy(*by).orderBy(*[F.desc_nulls_last(c) for c in newest])
    return log.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def current_tags(
    log: DataFrame,
    by: Sequence[str] = ("model_name", "version"),
    newest: Sequence[str] = ("assigned_at",),
) -> DataFrame:
    """Per version the tags of all its assignments; of one tag the newest value."""
    order = F.struct(*newest)
    entries = log.select(*by, order.alias("_at"), F.explode("tags").alias("key", "value"))
    latest = entries.groupBy(*by, "key").agg(F.max_by("value", "_at").alias("value"))
    return latest.groupBy(*by).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("tags")
    )


def promotion_decision(
    scores: DataFrame,
    role: str = "role",
    metric: str = "r2",
    champion: str = "Champion",
    challenger: str = "Challenger",
    by: Sequence[str] = (),
) -> DataFrame:
    """One row (per ``by`` group) deciding between the two roles.

    ``promoted`` if the challenger is strictly better or there is no champion,
    ``kept`` if not, ``no_challenger`` if there is none. A score that is NaN or
    infinite is no score, and a challenger without one is never promoted. A champion that is there
    but has no score is not "no champion": ``champion_present`` tells them apart
    and the decision is then ``kept``.
    """

    def of(name: str) -> Column:
        return F.max(F.when(F.col(role) == name, finite(F.col(metric))))

    def present(name: str) -> Column:
        return F.coalesce(F.max(F.col(role) == name), F.lit(False))

    row = scores.groupBy(*by).agg(
        of(champion).alias("champion_r2"),
        of(challenger).alias("challenger_r2"),
        present(champion).alias("champion_present"),
        present(challenger).alias("challenger_present"),
    )
    better = F.coalesce(F.col("challenger_r2") > F.col("champion_r2"), F.lit(False))
    scored = F.col("challenger_r2").isNotNull()
    wins = F.col("challenger_present") & scored & (~F.col("champion_present") | better)
    return row.withColumn("metric_r2_passed", wins).withColumn(
        "status",
        F.when(~F.col("challenger_present"), "no_challenger")
        .when(F.col("metric_r2_passed"), "promoted")
        .otherwise("kept"),
    )

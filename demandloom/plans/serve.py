"""Serve: champion against challenger on the test split, promotion, published predictions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from demandloom import settings as s
from demandloom.operators.evaluate import model_metrics
from demandloom.operators.lifecycle import promotion_decision
from demandloom.operators.publish import prediction_table
from demandloom.plans.dataset import Dataset
from demandloom.plans.modelbook import ModelBook
from demandloom.sources.tables import write_table

PUBLISHED = tuple(c for c in s.FEATURES)


@dataclass(frozen=True)
class Outcome:
    """``status`` is ``promoted``, ``kept``, ``no_challenger`` or ``not_compared``."""

    status: str
    challenger_version: int | None
    challenger_r2: float | None
    champion_r2: float | None
    metric_r2_passed: bool


def serve(
    data: Dataset,
    book: ModelBook,
    tables: s.Tables,
    lifecycle: s.Lifecycle | None = None,
    fmt: str = "parquet",
    compare: bool = True,
    exact: bool | str = False,
) -> Outcome:
    """Compare, promote and write the champion's predictions for the test split.

    Without ``compare``, as after a rejected candidate, an older challenger is left
    alone and the champion only predicts. All models are scored in one pass over the
    test rows; what ``select`` has scored on ``data`` is not scored again.

    Only a missing champion lets a challenger in without comparison; a champion
    that cannot be loaded or scored is an error. Nothing is published while there
    is no champion.
    """
    lifecycle = lifecycle or s.Lifecycle()
    name = lifecycle.model_name
    aliases = (lifecycle.champion, lifecycle.challenger) if compare else (lifecycle.champion,)
    holders = {alias: book.holder(name, alias) for alias in aliases}
    paths = {alias: row["model_path"] for alias, row in holders.items() if row is not None}
    outcome = Outcome("no_challenger" if compare else "not_compared", None, None, None, False)
    if not paths:
        return outcome
    models = {row["model_path"]: book.load(row) for row in holders.values() if row is not None}
    scored, columns = data.scored(models)
    predicted = {alias: columns[path] for alias, path in paths.items()}
    if lifecycle.challenger in predicted:
        decision = _compare(scored, predicted, lifecycle, exact)
        challenger = holders[lifecycle.challenger]
        outcome = Outcome(
            decision["status"],
            challenger["version"],
            decision["challenger_r2"],
            decision["champion_r2"],
            decision["metric_r2_passed"],
        )
        tags = {
            s.TAG_TEST_R2: str(decision["challenger_r2"]),
            s.TAG_PASSED: str(decision["metric_r2_passed"]),
        }
        if decision["champion_r2"] is not None:
            tags[s.TAG_CHAMPION] = str(decision["champion_r2"])
        # The comparison is recorded on the challenger whether it won or not.
        book.assign(name, lifecycle.challenger, challenger["version"], tags)
        if outcome.metric_r2_passed:
            book.assign(name, lifecycle.champion, challenger["version"], tags)
            predicted[lifecycle.champion] = predicted[lifecycle.challenger]
    if lifecycle.champion in predicted:
        published = prediction_table(scored, PUBLISHED, s.TARGET, predicted[lifecycle.champion])
        write_table(published, tables.predictions, fmt)
    return outcome


def _compare(scored: DataFrame, predicted: dict[str, str], lifecycle: s.Lifecycle, exact: bool | str):
    """All models' metrics over the same rows and the decision, as one job."""
    metrics = model_metrics(scored, s.TARGET, predicted, exact=exact)
    metrics = metrics.withColumnRenamed("model", "role")
    return promotion_decision(
        metrics, champion=lifecycle.champion, challenger=lifecycle.challenger
    ).first()

"""Train: fit on the train split, validate, record the run."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from demandloom import settings as s
from demandloom.operators.evaluate import regression_metrics
from demandloom.operators.trees import fit_tree, score
from demandloom.plans.dataset import Dataset
from demandloom.plans.modelbook import ModelBook

PREDICTION = "predicted_demand"


def train(
    data: Dataset,
    book: ModelBook,
    lifecycle: s.Lifecycle | None = None,
    spec: s.TreeSpec | None = None,
    exact: bool | str = False,
    categorical: Sequence[str] = s.CATEGORICAL,
    numeric: Sequence[str] = s.NUMERIC,
) -> str:
    """Returns the id of the recorded run. The vocabulary comes from the train split only."""
    lifecycle, spec = lifecycle or s.Lifecycle(), spec or s.TreeSpec()
    started = datetime.now(timezone.utc)
    train_rows = data.part("train")
    model = fit_tree(train_rows, s.TARGET, categorical, numeric, spec, PREDICTION)
    validated = regression_metrics(
        score(model, data.part("validation")), s.TARGET, PREDICTION, exact=exact
    )
    return book.log_run(
        model,
        lifecycle.run_name,
        spec.as_params(),
        dict(lifecycle.tags),
        validated.first().asDict(),
        started,
    )

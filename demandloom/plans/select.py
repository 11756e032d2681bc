"""Select: test the best run, register it if it passes the gate, make it the challenger."""

from __future__ import annotations

from dataclasses import dataclass

from demandloom import settings as s
from demandloom.operators.evaluate import regression_metrics
from demandloom.operators.lifecycle import best_run, quality_gate, require_row
from demandloom.plans.dataset import Dataset
from demandloom.plans.modelbook import ModelBook


@dataclass(frozen=True)
class Selection:
    """``status`` is ``rejected`` or ``registered``; ``version`` is None if rejected."""

    run_id: str
    test_r2: float | None
    threshold: float
    status: str
    version: int | None


def _champion(book: ModelBook, lifecycle: s.Lifecycle) -> dict:
    """The champion is going to be compared on the same rows, so it is scored with the candidate.

    One that cannot be loaded is left to ``serve``, which makes it an error.
    """
    row = book.holder(lifecycle.model_name, lifecycle.champion, registered=False)
    return {row["model_path"]: book.load(row)} if row is not None and book.exists(row) else {}


def select(
    data: Dataset, book: ModelBook, lifecycle: s.Lifecycle | None = None, exact: bool | str = False
) -> Selection:
    lifecycle = lifecycle or s.Lifecycle()
    run = require_row(
        best_run(book.runs(), lifecycle.metric, lifecycle.run_name, recency=["commit"]),
        f"no finished run named {lifecycle.run_name}",
    )
    path = run["model_path"]
    scored, columns = data.scored({path: book.load(run), **_champion(book, lifecycle)})
    gate = quality_gate(
        regression_metrics(scored, s.TARGET, columns[path], exact=exact), "r2", lifecycle.threshold
    ).first()
    if not gate["passed"]:
        return Selection(run["run_id"], gate["r2"], lifecycle.threshold, "rejected", None)
    version = book.register(lifecycle.model_name, run)
    tags = {s.TAG_TEST_R2: str(gate["r2"]), s.TAG_STATUS: s.TAG_CLEARED}
    book.assign(lifecycle.model_name, lifecycle.challenger, version, tags)
    return Selection(run["run_id"], gate["r2"], lifecycle.threshold, "registered", version)

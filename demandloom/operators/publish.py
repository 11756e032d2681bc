"""Shape of the published predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prediction_table(
    scored: DataFrame,
    features: Sequence[str],
    label: str,
    prediction: str,
    stamp: str | None = "timestamp",
) -> DataFrame:
    """Features, then ``actual_demand``, ``predicted_demand`` and the scoring time."""
    columns = [
        *[F.col(c) for c in features],
        F.col(label).cast("double").alias("actual_demand"),
        F.col(prediction).cast("double").alias("predicted_demand"),
    ]
    if stamp:
        columns.append(F.current_timestamp().alias(stamp))
    return scored.select(*columns)

"""Regression tree: fit, score, save, load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.operators.encode import Vocabulary, encoding_stages, require_columns
from demandloom.settings import TreeSpec


def fit_tree(
    train: DataFrame,
    label: str,
    vocabulary: Vocabulary | Sequence[str],
    numeric: Sequence[str],
    spec: TreeSpec | None = None,
    prediction: str = "predicted_demand",
) -> PipelineModel:
    """Encoder and tree as one fitted pipeline.

    ``vocabulary`` may be the names of the categorical columns alone; their values then
    come from ``train``.

    The fit reads ``train`` several times (thresholds, then the binned rows,
    which the learner caches), so pass a written table. Node ids are cached per
    row rather than re-derived by walking the growing tree, and checkpointed.
    A row without a label has nothing to teach and is left out of the fit.
    """
    spec = spec or TreeSpec()
    require_columns(train, [label, *vocabulary, *numeric])
    tree = DecisionTreeRegressor(
        featuresCol="features",
        labelCol=label,
        predictionCol=prediction,
        impurity="variance",
        maxDepth=spec.max_depth,
        minInstancesPerNode=spec.min_leaf,
        maxBins=spec.max_bins,
        seed=spec.seed,
        maxMemoryInMB=512,
        cacheNodeIds=True,
        checkpointInterval=10,
    )
    used = train.select(label, *dict.fromkeys([*vocabulary, *numeric])).where(
        F.col(label).isNotNull()
    )
    return Pipeline(stages=[*encoding_stages(vocabulary, numeric), tree]).fit(used)


def score(model: PipelineModel, df: DataFrame, prediction: str = "predicted_demand") -> DataFrame:
    """``df`` with the prediction column; the encoder's columns are left out."""
    return model.transform(df).select(*df.columns, prediction)


def save_model(model: PipelineModel, path: str) -> str:
    """Encoder and tree in one directory; ``path`` should be on shared storage."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)

"""Quality rules: fixed limits, then an isolation forest over rule statistics."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import documents, least_hashed, table
from demandloom.llm.features import RATIOS
from demandloom.llm.textstats import with_counts
from demandloom.session import materialize

STATISTICS = tuple(RATIOS)
TREES = 100
# Reference rows per tree; trees x this many are the bounded sample of the forest, and as
# many other rows are its surroundings.
SUBSAMPLE = 256
# Other rows per tree: they widen the ranges in which it cuts and have no weight.
AROUND = 2048
# Splits beyond those that would isolate one of ``SUBSAMPLE`` rows in a balanced tree.
SPARE_SPLITS = 4
# A statistic's unit: the range of the reference rows without these tails, but at least
# this share of the range of all rows.
TAIL = 0.001
LEAST_SPREAD = 0.02
SEED = 17
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
# Share of the clean labelled rows that the threshold may reject.
CLEAN_LOSS = 0.001
# Scores are compared in steps of this size while the threshold is sought.
STEP = 0.001


def mean_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a random binary tree of ``n`` rows."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    harmonic = sum(1 / i for i in range(1, n))
    return 2 * harmonic - 2 * (n - 1) / n


@dataclass
class Tree:
    """Nodes in lists; a leaf has feature -1 and its path length in ``cut``."""

    feature: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)


def grow(
    rows: Sequence[Sequence[float]],
    rng: random.Random,
    limit: int,
    around: Sequence[Sequence[float]] = (),
    spread: Sequence[float] | None = None,
) -> Tree:
    """Random splits until a part has no reference row, one distinct row, or ``limit`` splits.

    A split takes a statistic with a chance in proportion to the range of the part, counted
    in ``spread`` (1 for each without it), and cuts at any place of that range. The rows
    ``around`` take part in the ranges only: what lies apart from all reference rows is
    isolated soon, however many rows lie there together.
    """
    import numpy as np

    tree = Tree()

    def node(part, others, depth: int) -> int:
        at = len(tree.feature)
        for column in (tree.feature, tree.left, tree.right):
            column.append(-1)
        tree.cut.append(depth + mean_path(len(part)))
        if depth == limit or not len(part):
            return at
        both = np.concatenate([part, others])
        low, high = both.min(axis=0), both.max(axis=0)
        chances = (high - low) / unit
        if chances.any():
            f = rng.choices(range(len(unit)), chances)[0]
            cut = rng.uniform(low[f], high[f])
            tree.feature[at], tree.cut[at] = f, cut
            below, under = part[:, f] <= cut, others[:, f] <= cut
            tree.left[at] = node(part[below], others[under], depth + 1)
            tree.right[at] = node(part[~below], others[~under], depth + 1)
        return at

    if len(rows):
        part = np.asarray(rows, dtype=float)
        unit = np.ones(part.shape[1]) if spread is None else np.asarray(spread, dtype=float)
        node(part, np.asarray(around, dtype=float).reshape(-1, part.shape[1]), 0)
    return tree


def clean_ids(labels: DataFrame) -> DataFrame:
    """``doc_id`` of the rows labelled 1, and never 0."""
    return (
        labels.where("doc_id is not null and quality in (0, 1)")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("least"))
        .where("least = 1")
        .select("doc_id", F.lit(True).alias("clean"))
    )


def spreads(rows, others):
    """The unit of each statistic: the spread of ``rows``, see ``TAIL`` and ``LEAST_SPREAD``."""
    import numpy as np

    low, high = np.quantile(rows, (TAIL, 1 - TAIL), axis=0)
    both = np.concatenate([rows, others])
    unit = np.maximum(high - low, LEAST_SPREAD * (both.max(axis=0) - both.min(axis=0)))
    return np.where(unit > 0, unit, 1.0)


def fit_forest(
    stats: DataFrame,
    labels: DataFrame,
    columns=STATISTICS,
    trees=TREES,
    subsample=SUBSAMPLE,
    around=AROUND,
    seed=SEED,
) -> list[Tree]:
    """A forest in which the texts labelled clean are what a split isolates from.

    Poor texts are so many and so alike that a forest over all texts takes them for usual.
    So the weight in a tree is that of clean texts, and all others only widen its ranges;
    without a clean text all are reference rows. The sample is bounded by the method: of
    each kind the ``trees * subsample`` distinct texts of least hash. Distinct, so that a
    large group of copies weighs as one text; by hash, so that neither order nor
    partitioning matters.
    """
    import numpy as np

    marked = stats.join(clean_ids(labels), "doc_id", "left")
    texts = materialize(
        marked.groupBy("text_hash", *columns).agg(
            F.coalesce(F.max("clean"), F.lit(False)).alias("clean")
        ),
        "distinct-texts",
    )

    def sample(part: DataFrame):
        least = least_hashed(part, "text_hash", trees * subsample, *columns)
        rows = sorted(tuple(r) for r in least.select(*columns).collect())
        return np.array(rows, dtype=float).reshape(-1, len(columns))

    rows, others = sample(texts.where("clean")), sample(texts.where("not clean"))
    if not len(rows):
        rows, others = others, rows
    if not len(rows):
        return [Tree()] * trees
    unit = spreads(rows, others)
    rng = random.Random(seed)
    order = rng.sample(range(len(rows)), len(rows))
    share = min(subsample, len(rows))
    limit = max(share - 1, 1).bit_length() + SPARE_SPLITS
    forest = []
    for i in range(trees):
        chosen = order[i * share : (i + 1) * share]
        if len(chosen) < share:
            chosen = rng.sample(order, share)
        near = rng.sample(range(len(others)), min(around, len(others)))
        forest.append(grow(rows[chosen], rng, limit, others[near], unit))
    return forest


def anomaly(stats: DataFrame, forest: list[Tree], columns=STATISTICS, subsample=SUBSAMPLE):
    """``stats`` with ``anomaly``: 2 to the power of minus mean path over expected path."""
    import numpy as np

    grown = [
        tuple(np.array(column) for column in (t.feature, t.cut, t.left, t.right))
        for t in forest
        if t.feature
    ]
    n_trees, expected = len(forest), max(mean_path(subsample), 1e-9)

    def score(*values):
        import numpy as np
        import pandas as pd

        x = np.column_stack([v.to_numpy(dtype=float) for v in values])
        total = np.zeros(len(x))
        for feature, cut, left, right in grown:
            at = np.zeros(len(x), dtype=int)
            inner = np.arange(len(x))
            while len(inner):
                here = at[inner]
                inner, here = inner[feature[here] >= 0], here[feature[here] >= 0]
                low = x[inner, feature[here]] <= cut[here]
                at[inner] = np.where(low, left[here], right[here])
            total += cut[at]
        return pd.Series(2.0 ** (-total / n_trees / expected))

    scored = F.pandas_udf(score, "double")
    return stats.withColumn("anomaly", scored(*(F.col(c) for c in columns)))


def threshold(scored: DataFrame, labels: DataFrame, clean_loss=CLEAN_LOSS) -> float:
    """The lowest anomaly score above which at most ``clean_loss`` of clean rows lie.

    All labelled rows count: 1 is clean, 0 is not; other labels are ignored. Moved up
    to just below the next rejected row, to stand clear of the clean ones. Without
    rows of both labels nothing is rejected.
    """
    usable = labels.where("quality in (0, 1)").select("doc_id", "quality").distinct()
    steps = (
        scored.where("not base_failed")
        .join(usable, "doc_id")
        .groupBy(F.ceil(F.col("anomaly") / STEP).alias("step"))
        .agg(F.sum("quality").alias("clean"), F.sum(1 - F.col("quality")).alias("poor"))
        .orderBy(F.desc("step"))
        .collect()
    )
    allowed = clean_loss * sum(r["clean"] for r in steps)
    lost, found = 0, float("inf")
    for r in steps:
        lost += r["clean"]
        if lost > allowed:
            break
        if r["poor"]:
            found = (r["step"] - 1) * STEP
    return found


@dataclass
class RuleModel:
    """A fitted forest and the anomaly score up to which a document is kept."""

    forest: list[Tree]
    limit: float

    def judge(self, stats: DataFrame) -> DataFrame:
        scored = anomaly(stats, self.forest)
        return scored.withColumn(
            "kept", ~F.col("base_failed") & (F.col("anomaly") <= F.lit(self.limit))
        )


def statistics(docs: DataFrame) -> DataFrame:
    """Packed rows with their counts, rule statistics and ``base_failed``."""
    return (
        with_counts(docs)
        .withColumn("text_hash", F.xxhash64("_row.text"))
        .withColumns({name: F.expr(sql) for name, sql in RATIOS.items()})
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
        )
    )


def fit(stats: DataFrame, labels: DataFrame) -> RuleModel:
    forest = fit_forest(stats.where("not base_failed"), labels)
    scored = materialize(anomaly(stats, forest), "anomaly")
    return RuleModel(forest, threshold(scored, labels))


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per row of ``docs``: the base counts, ``base_failed``, ``anomaly`` and ``kept``.

    ``base_failed``: under 20 words, or over 30 % of the words in repeated 8-word
    windows; a NULL or empty text fails so. Other rows are kept up to the calibrated
    anomaly score: how soon random splits set a text's ratios apart from those of clean
    texts. Repeated rows give equal results. A NULL ``doc_id`` is scored like any other;
    it never meets a label. Only ``doc_id`` and ``text`` are read. An empty table gives no
    rows; without labels nothing but the base rules rejects.
    """
    stats = materialize(statistics(docs.select("doc_id", "text")).drop("_row"), "rule-statistics")
    return fit(stats, labels).judge(stats)


def op3(spark, sf_dir: str) -> DataFrame:
    checked = quality_rules(documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return checked.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "anomaly",
    )


def keep_clean(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go.

    The counts are written once, beside the rows they belong to: fit and verdict read them
    there, and no text goes through a join. Columns are those of ``docs``.
    """
    stats = materialize(statistics(docs), "rule-statistics")
    model = fit(stats.drop("_row"), table(spark, sf_dir, "labels"))
    return model.judge(stats).where("kept").select("_row.*")

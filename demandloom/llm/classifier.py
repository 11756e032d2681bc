"""Quality classifier: a sparse ensemble of rules, compiled to column expressions."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import documents, least_hashed, table
from demandloom.llm.features import LOG_WORDS, RATIOS
from demandloom.llm.textstats import with_counts
from demandloom.session import materialize

STATISTICS = {**RATIOS, "log_words": LOG_WORDS}
# Labelled rows the classifier is fitted on, at most: those of least id hash.
SAMPLE = 20_000
TREES, DEPTH = 15, 3
LASSO = 0.002
SEED = 29
CUTOFF = 0.3
FOLDS = 5

# (statistic, above, threshold): one comparison of a rule.
Test = tuple[str, bool, float]
Rule = tuple[Test, ...]


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from. A NULL id has the text ''."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS == 0


def tree_paths(root, names: list[str]) -> list[Rule]:
    """The conjunction of tests on the way to each node of a tree, the root left out."""
    found: list[Rule] = []

    def walk(node, path: Rule) -> None:
        if path:
            found.append(path)
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, cut = names[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), (*path, (name, False, cut)))
        walk(node.rightChild(), (*path, (name, True, cut)))

    walk(root, ())
    return found


def simplified(rule: Rule) -> Rule:
    """The tightest test for each statistic and direction, in a fixed order."""
    tightest: dict[tuple[str, bool], float] = {}
    for name, above, cut in rule:
        known = tightest.get((name, above), cut)
        tightest[name, above] = max(known, cut) if above else min(known, cut)
    return tuple(sorted((n, a, c) for (n, a), c in tightest.items()))


def condition(rule: Rule) -> Column:
    tests = (F.col(n) > c if above else F.col(n) <= c for n, above, c in rule)
    return reduce(lambda x, y: x & y, tests)


@dataclass
class RuleEnsemble:
    """``intercept`` plus the weights of the rules that hold, as log odds of label 1."""

    intercept: float
    weights: list[tuple[float, Rule]]

    def score(self) -> Column:
        """The probability of label 1 as one expression over the statistics."""
        odds = F.lit(self.intercept)
        for weight, rule in self.weights:
            odds = odds + F.when(condition(rule), weight).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))

    def judge(self, stats: DataFrame) -> DataFrame:
        return stats.withColumn("score", self.score()).withColumn(
            "predicted", (F.col("score") >= CUTOFF).cast("int")
        )


def statistics(docs: DataFrame) -> DataFrame:
    """Packed rows with ``held_out`` and the statistics; the id is no statistic."""
    return with_counts(docs).select(
        "_row", "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        *(F.expr(sql).alias(name) for name, sql in STATISTICS.items()),
    )


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Statistics and ``label`` of at most ``sample`` labelled rows that are not held out.

    A document labelled both ways and labels other than 0 and 1 are left out. Labels
    are cut to the bound before the texts are read, so one bounded set meets them.
    """
    usable = (
        labels.where(~held_out(F.col("doc_id")))
        .where("doc_id is not null and quality is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").alias("low"), F.max("quality").alias("high"))
        .where("low = high and low in (0, 1)")
        .select(
            F.col("doc_id").alias("_id"),
            F.col("low").cast("double").alias("label"),
            F.xxhash64("doc_id").alias("_hash"),
        )
    )
    usable = least_hashed(materialize(usable, "labels"), "_hash", sample, "_id").drop("_hash")
    usable = materialize(usable, "label-sample")
    # The sample has at most 20,000 rows of 16 bytes, by its limit.
    chosen = docs.select("doc_id", "text").join(
        F.broadcast(usable.select("_id")), F.col("doc_id") == F.col("_id"), "left_semi"
    )
    rows = statistics(chosen).drop("_row").join(
        F.broadcast(usable), F.col("doc_id") == F.col("_id")
    )
    return rows.drop("_id")


def fit(train: DataFrame, lasso: float = LASSO) -> RuleEnsemble:
    """Tree paths of a random forest as rules, weighted by a lasso logistic regression.

    Without rows of both labels the ensemble has no rule and scores their share, 0.5
    without any row.
    """
    names = list(STATISTICS)
    # The bounded sample in one fixed order: the forest draws its rows by their place.
    train = train.select("label", *names).distinct().repartition(1)
    train = materialize(train.sortWithinPartitions("label", *names), "training-rows")
    total, good = train.agg(F.count("*"), F.sum("label")).first()
    if not total or good in (0, total):
        share = (good or 0) / total if total else 0.5
        return RuleEnsemble({0: -20.0, 1: 20.0}.get(share, 0.0), [])
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(train)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, maxBins=64, featureSubsetStrategy="onethird"
    ).fit(assembled)
    rules = sorted(
        {
            simplified(path)
            for tree in forest.trees
            for path in tree_paths(tree._java_obj.rootNode(), names)
        }
    )
    if not rules:
        return RuleEnsemble(0.0, [])
    flags = F.array(*(condition(r).cast("double") for r in rules))
    flagged = materialize(train.select("label", flags.alias("flags")).coalesce(1), "rule-flags")
    lasso_fit = LogisticRegression(
        featuresCol="rules", elasticNetParam=1.0, regParam=lasso, maxIter=60
    ).fit(flagged.select("label", array_to_vector("flags").alias("rules")))
    weights = [
        (float(w), r)
        for w, r in zip(lasso_fit.coefficients.toArray(), rules, strict=True)
        if abs(w) > 1e-9
    ]
    return RuleEnsemble(float(lasso_fit.intercept), weights)


def op1(spark, sf_dir: str) -> DataFrame:
    """Score of every whole text; see ``statistics``, ``fit`` and ``RuleEnsemble``.

    A NULL or empty text has statistics of 0 and is scored by them. Repeated rows
    score alike; further columns are never read.
    """
    docs, labels = documents(spark, sf_dir), table(spark, sf_dir, "labels")
    model = fit(training_rows(docs, labels))
    stats = statistics(docs.select("doc_id", "text"))
    return model.judge(stats).select("doc_id", "held_out", "score", "predicted")


def keep_good(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the classifier rejects go.

    Fitted like ``op1`` on the labelled documents as they came: earlier stages have
    removed nearly all poor ones from ``docs``.
    """
    model = fit(training_rows(documents(spark, sf_dir), table(spark, sf_dir, "labels")))
    return model.judge(statistics(docs)).where("predicted = 1").select("_row.*")

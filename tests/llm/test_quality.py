import random
import zlib

import pytest
from demandloom.llm import classifier, rules, textstats
from demandloom.session import materialize
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\x0c\r"
SF = "/root/testdata/sf0.01"


def split(text):
    for b in BLANKS:
        text = text.replace(b, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    words = split(text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    inside = set()
    for i, w in enumerate(windows):
        if windows.count(w) > 1:
            inside |= set(range(i, i + 8))
    lines = text.split("\n")
    dup = sum(bool(split(x)) and x in lines[:i] for i, x in enumerate(lines))
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        len(inside),
    )


@given(st.text(alphabet="ab \n#é\x1c\x85|", max_size=120))
def test_base_counts(text):
    assert textstats.count(text)[:5] == brute(text)


@given(st.lists(st.sampled_from("abc"), max_size=60))
def test_repeated_windows(words):
    text = " ".join(words)
    assert textstats.count(text)[4] == brute(text)[4]


def test_counts_of_null_are_those_of_empty():
    assert textstats.count(None) == textstats.count("")


def test_path_lengths_are_short_for_outliers():
    rng = random.Random(1)
    rows = [(rng.random() / 100, 0.0) for _ in range(255)] + [(5.0, 3.0)]
    trees = [rules.grow(rows, random.Random(i), 8) for i in range(30)]

    def depth(tree, row):
        at = 0
        while tree.feature[at] >= 0:
            low = row[tree.feature[at]] <= tree.cut[at]
            at = (tree.left if low else tree.right)[at]
        return tree.cut[at]

    mean = lambda row: sum(depth(t, row) for t in trees) / len(trees)
    assert mean((5.0, 3.0)) < 3 < mean(rows[0])
    assert rules.grow([], rng, 8).feature == []
    assert rules.grow([(1.0, 1.0)] * 5, rng, 8).feature == [-1]


def test_rows_around_widen_ranges_without_weight():
    """A dense group away from the reference rows is isolated all the sooner."""
    rng = random.Random(3)
    rows = [(rng.random(), 0.0) for _ in range(64)]
    far = [(rng.random(), 9.0) for _ in range(64)]

    def depth(tree, row):
        at = 0
        while tree.feature[at] >= 0:
            at = (tree.left if row[tree.feature[at]] <= tree.cut[at] else tree.right)[at]
        return tree.cut[at]

    for around, apart in ((far, True), ([], False)):
        trees = [rules.grow(rows, random.Random(i), 8, around) for i in range(30)]
        near, away = (sum(depth(t, r) for t in trees) / 30 for r in (rows[0], far[0]))
        assert (away < near / 2) == apart


def test_mean_path():
    assert rules.mean_path(0) == rules.mean_path(1) == 0
    assert rules.mean_path(2) == 1.0
    assert rules.mean_path(256) == pytest.approx(10.24, abs=0.05)


def scored(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, anomaly double, base_failed boolean")


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_threshold_rejects_poor_rows_and_no_clean_ones(spark):
    rows = [(i, 0.3 + i / 1000, False) for i in range(100)] + [(200, 0.8, False), (201, 0.7, True)]
    labels = [(i, 1, 0) for i in range(100)] + [(200, 0, 0), (201, 0, 0), (None, 0, 0), (5, None, 0)]
    limit = rules.threshold(scored(spark, rows), labelled(spark, labels))
    assert 0.399 <= limit < 0.8


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)], [(9, 0, 0)]])
def test_threshold_without_both_labels(spark, labels):
    limit = rules.threshold(scored(spark, [(1, 0.5, False)]), labelled(spark, labels))
    assert limit > 0.5


def outcome(spark, found, labels):
    joined = found.join(labels, "doc_id")
    rows = joined.groupBy("quality", "chosen").count().collect()
    return {(r["quality"], r["chosen"]): r["count"] for r in rows}


def test_rules_reject_poor_documents_and_keep_clean_ones(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = rules.op3(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r["doc_id"]: r for r in found.collect()}
    for r in docs[::7]:
        row = got[r["doc_id"]]
        want = textstats.count(r["text"])[:5]
        assert tuple(row[c] for c in columns) == want
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert row["base_failed"] == failed and not (failed and row["kept"])
    clean = found.where("not base_failed").withColumn("chosen", F.col("kept"))
    n = outcome(spark, clean, labels)
    assert n.get((0, True), 0) <= 0.1 * n.get((0, False), 1)
    assert n.get((1, False), 0) <= 0.005 * n[(1, True)]


def test_scores_are_mean_paths(spark):
    """``anomaly`` against a walk of every row through every tree."""
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    stats = materialize(rules.statistics(docs).drop("_row"), "test-statistics")
    model = rules.fit(stats, labels)
    for r in model.judge(stats).collect():
        total = 0.0
        for tree in model.forest:
            at = 0
            while tree.feature[at] >= 0:
                low = r[rules.STATISTICS[tree.feature[at]]] <= tree.cut[at]
                at = (tree.left if low else tree.right)[at]
            total += tree.cut[at]
        want = 2 ** (-total / rules.TREES / rules.mean_path(rules.SUBSAMPLE))
        assert r["anomaly"] == pytest.approx(want, rel=1e-12)
        assert r["kept"] == (not r["base_failed"] and want <= model.limit)


def test_forest_on_labels_it_never_saw(spark):
    """Fitted and calibrated on every second labelled row, judged on the others."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stats = materialize(rules.statistics(docs).drop("_row"), "test-statistics")
    seen = F.xxhash64("doc_id") % 2 == 0
    found = rules.fit(stats, labels.where(seen)).judge(stats).where("not base_failed")
    n = outcome(spark, found.withColumn("chosen", F.col("kept")), labels.where(~seen))
    assert n.get((0, True), 0) <= 0.03 * n[(0, False)]
    assert n.get((1, False), 0) <= 0.003 * n[(1, True)]


def test_forest_decides_by_the_labels_and_not_by_limits(spark):
    """Poor texts whose every ratio is one that clean prose may have, but not so together."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(vocabulary) for _ in range(120)]
        poor = i % 10 == 0
        if poor:
            # 0.08 symbols a word: below any limit that a person would set.
            for j in rng.sample(range(120), 10):
                words[j] += "#"
        rows.append((i, " ".join(words)))
        labels.append((i, 0 if poor else 1, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r["doc_id"]: r["kept"] for r in rules.quality_rules(docs, labelled(spark, labels)).collect()}
    poor = [i for i in range(600) if i % 10 == 0]
    assert not any(kept[i] for i in poor)
    assert all(kept[i] for i in range(600) if i % 10)


def test_classifier_on_rows_it_never_saw(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = classifier.op1(spark, SF).cache()
    for r in found.collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    unseen = found.where("held_out").withColumn("chosen", F.col("predicted"))
    n = outcome(spark, unseen, labels)
    assert n.get((0, 1), 0) <= 0.1 * n[(0, 0)]
    assert n.get((1, 0), 0) <= 0.02 * n[(1, 1)]


def test_the_fit_does_not_depend_on_the_order_of_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    models = [
        classifier.fit(classifier.training_rows(d, l))
        for d, l in ((docs, labels), (docs.repartition(5), labels.repartition(3)))
    ]
    assert models[0] == models[1] and models[0].weights


def test_rules_on_edges(spark, edges):
    labels = labelled(spark, [(1, 0, 0), (6, 1, 0)])
    rows = rules.quality_rules(edges, labels).collect()
    assert len(rows) == edges.count()
    failed = {r["doc_id"]: r["base_failed"] for r in rows}
    assert [failed[i] for i in (1, 2, 3, 4, 6, 9)] == [True, True, True, True, True, False]


def test_classifier_on_edges_and_odd_labels(spark, edges):
    labels = [(i, i % 2, 0) for i in range(10)] + [(4, 1, 0), (5, None, 0), (6, 7, 0), (None, 1, 0)]
    train = classifier.training_rows(edges, labelled(spark, labels))
    assert {r["doc_id"] for r in train.collect()} <= {1, 2, 3, 5, 7, 8, 9}
    model = classifier.fit(train)
    rows = model.judge(classifier.statistics(edges)).collect()
    assert len(rows) == edges.count()
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("quality, expected", [(None, 0.5), (1, 1.0), (0, 0.0)])
def test_classifier_without_both_labels(spark, edges, quality, expected):
    rows = [] if quality is None else [(i, quality, 0) for i in range(10)]
    model = classifier.fit(classifier.training_rows(edges, labelled(spark, rows)))
    score = model.judge(classifier.statistics(edges)).first()["score"]
    assert score == pytest.approx(expected, abs=1e-6)


def test_empty(spark, nothing):
    labels = labelled(spark, [(1, 0, 0), (2, 1, 0)])
    assert rules.quality_rules(nothing, labels).collect() == []
    model = classifier.fit(classifier.training_rows(nothing, labels))
    assert model.judge(classifier.statistics(nothing)).collect() == []


def test_rules_compile_to_the_tightest_tests(spark):
    rule = classifier.simplified((("a", True, 1.0), ("a", True, 2.0), ("a", False, 9.0), ("b", False, 3.0)))
    assert rule == (("a", False, 9.0), ("a", True, 2.0), ("b", False, 3.0))
    frame = spark.createDataFrame([(2.0, 3.0), (2.5, 3.0), (2.5, 3.5)], "a double, b double")
    assert [r[0] for r in frame.select(classifier.condition(rule)).collect()] == [False, True, False]


@pytest.mark.parametrize("bound", [5, 50, 500])
def test_bounded_sample_takes_the_least(spark, bound):
    from demandloom.llm.common import least_hashed

    rows = spark.range(300).select("id", F.xxhash64("id").alias("h"))
    got = [r["h"] for r in least_hashed(rows, "h", bound, "id").collect()]
    want = sorted(r["h"] for r in rows.collect())[: len(got)]
    assert sorted(got) == want and min(bound, 300) * 0.6 <= len(got) <= bound


def test_stages_keep_columns(spark, edges):
    for stage in (rules.keep_clean, classifier.keep_good):
        kept = stage(spark, edges, SF)
        assert kept.columns == edges.columns and kept.count() <= edges.count()


def test_stage_learns_from_the_documents_as_they_came(spark):
    """Poor rows that have no label and come after the rules: the stage's rows hold no poor label."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = docs.join(labels.where("quality = 1"), "doc_id", "left_semi")
    poor = docs.join(labels.where("quality = 0"), "doc_id", "left_semi")
    poor = poor.withColumn("doc_id", F.col("doc_id") + 10**9)
    kept = classifier.keep_good(spark, good.unionByName(poor), SF)
    n_poor = kept.where(F.col("doc_id") >= 10**9).count()
    assert n_poor <= 0.1 * poor.count()
    assert kept.count() - n_poor >= 0.98 * good.count()

"""Corpus preparation: rules, quality, near-duplicates, repeated passages, packing.

``STAGES`` lists ``(name, function)``. Each function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import classifier, packing, rules, simhash, suffixes
from demandloom.llm.common import documents
from demandloom.session import materialize

STAGES = [
    ("quality rules", rules.keep_clean),
    ("quality classifier", classifier.keep_good),
    ("simhash near-dedup", simhash.keep_one),
    ("suffix-array dedup", suffixes.drop_repeats),
    ("packing", packing.packed),
]

# No stage sequence of this kind is expressible in SQL: two stages are fitted models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``, each result written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

import pytest

from demandloom.llm.common import prepare

# Edge cases of every operator on documents: NULLs, empty, blank, ties and repeated rows,
# and further columns whose names the operators use themselves.
EDGES = [
    (None, None, None, None, None, 1, "x", 0.5),
    (None, "a NULL id, cc by", "en", "s", 5, 1, "x", 0.5),
    (1, None, "en", None, None, 2, "x", None),
    (2, "", "en", "s", 0, None, None, 0.5),
    (3, " \t\n\r ", "en", "s", 5, 1, "x", 0.5),
    (4, "one", "en", "s", 3, 1, "x", 0.5),
    (5, "Ünï ççdé 中文 😀 word", "de", "s", 17, 1, "x", 0.5),
    (6, "the same text twice over, all rights reserved. " * 20, "en", "s", 940, 1, "x", 0.5),
    (7, "the same text twice over, all rights reserved. " * 20, "en", "s", 940, 1, "x", 0.5),
    (7, "the same text twice over, all rights reserved. " * 20, "en", "s", 940, 1, "x", 0.5),
    (8, "x" * 5000, "en", "s", 5000, 1, "x", 0.5),
    (9, " ".join(f"w{i * i % 977}x{i}" for i in range(30_000)), "en", "s", 1, 1, "x", 0.5),
]
EDGE_SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, n_words int, "
    "shard string, score double"
)
PLAIN_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def edges(spark):
    return spark.createDataFrame(EDGES, EDGE_SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], PLAIN_SCHEMA)


@pytest.fixture(scope="session")
def corpus(spark):
    """The documents of the smallest given size, as (id, text) pairs and as a frame."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in docs.collect()], docs


def texts(edges):
    return [(r["doc_id"], r["text"] or "") for r in edges.collect()]

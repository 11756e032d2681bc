"""Counts over one text that the quality operators share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLANKS = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

COUNTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_distinct_words",
    "n_lines",
    "n_upper",
    "n_lower",
    "n_digits",
    "n_ends",
    "n_shouts",
    "n_commas",
    "n_pipes",
    "longest_word",
)


def repeat_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word runs that occur twice or more, all occurrences included.

    Runs of 2, 4 and 8 words are numbered exactly, by pairs of the numbers of their
    halves; a text without a repeated shorter run is done there.
    """
    import numpy as np

    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    n = len(words)
    if n <= window:
        return 0
    first: dict[bytes, int] = {}
    code = np.array(list(map(first.setdefault, words, range(n))), dtype=np.int64)
    span = 1
    while True:
        _, code, count = np.unique(code, return_inverse=True, return_counts=True)
        if len(count) == len(code):
            return 0
        if span == window:
            break
        code = code[:-span] * n + code[span:]
        span *= 2
    starts = np.flatnonzero(count[code] > 1)
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge) > 0).sum())


def count(text: str | None) -> tuple[int, ...]:
    """The values of ``COUNTS``. Words are runs of other than the six ASCII blanks."""
    text = text or ""
    data = text.encode()
    words = data.split()

    def among(chars: bytes) -> int:
        return len(data) - len(data.translate(None, chars))

    lines = [line for line in data.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text) - among(BLANKS),
        among(SYMBOLS),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(set(words)),
        len(lines),
        among(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        among(b"abcdefghijklmnopqrstuvwxyz"),
        among(b"0123456789"),
        among(b".?"),
        among(b"!"),
        among(b",;"),
        among(b"|"),
        max(map(len, words), default=0),
    )


def with_counts(docs: DataFrame) -> DataFrame:
    """``_row`` (a whole row of ``docs``), its ``doc_id`` and the ``COUNTS`` of its text.

    The row is packed so that none of its columns can clash with a count. A NULL text
    counts as empty.
    """

    def counts(texts):
        import pandas as pd

        return pd.DataFrame(list(map(count, texts)), columns=list(COUNTS))

    # Not deterministic to the optimizer: a filter above must not repeat the counting.
    udf = F.pandas_udf(counts, ", ".join(f"{c} long" for c in COUNTS)).asNondeterministic()
    packed = docs.select(F.struct("*").alias("_row"))
    return packed.withColumn("_counts", udf(F.col("_row.text"))).select(
        "_row", F.col("_row.doc_id").cast("long").alias("doc_id"), "_counts.*"
    )

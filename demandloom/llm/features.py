"""Ratios of text counts as SQL expressions."""

from __future__ import annotations


def _per(count: str, base: str) -> str:
    return f"{count} / greatest({base}, 1)"


# No ratio grows with the length of a text; the logarithm of its words does.
RATIOS = {
    "symbols": _per("n_symbols", "word_chars"),
    "word_length": _per("word_chars", "n_words"),
    "dup_lines": _per("n_dup_lines", "n_lines"),
    "repeats": _per("n_repeat_words", "n_words"),
    "variety": _per("n_distinct_words", "n_words"),
    "upper": _per("n_upper", "n_upper + n_lower"),
    "digits": _per("n_digits", "word_chars"),
    "ends": _per("n_ends", "n_words"),
    "shouts": _per("n_shouts", "n_words"),
    "commas": _per("n_commas", "n_words"),
    "pipes": _per("n_pipes", "n_words"),
}
LOG_WORDS = "log1p(n_words)"

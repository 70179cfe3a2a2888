"""String column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_to_double(text) -> Column:
    """``1,234.50`` → 1234.5; unparsable → NULL."""
    return F.regexp_replace(_c(text).cast("string"), ",", "").try_cast("double")


def to_text(x) -> Column:
    return _c(x).cast("string")


def text_length(x) -> Column:
    return F.length(_c(x))


def upper_text(x) -> Column:
    return F.upper(_c(x))


def regex_group(x, pattern: str, group: int) -> Column:
    """Capture group of ``pattern`` (empty string when no match)."""
    return F.regexp_extract(_c(x), pattern, group)


def instruction_text(question, answer) -> Column:
    """``question: <q> answer: <a>``; NULL when either part is NULL."""
    return F.concat(F.lit("question: "), _c(question), F.lit(" answer: "), _c(answer))


def whitespace_tokens(text) -> Column:
    """Split trimmed text on runs of whitespace; empty text → empty array."""
    t = F.trim(_c(text))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, r"\s+"))


def cap_tokens(text, n: int) -> Column:
    """Keep the first ``n`` whitespace tokens of the text (a feature: max sequence length)."""
    return F.array_join(F.slice(whitespace_tokens(text), 1, n), " ")



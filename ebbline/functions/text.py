"""Tokenisers as built-in expressions (no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A run of non-word characters (ASCII class), and the characters
# Python's str.split() treats as white space.
NON_WORD = r"\W+"
UNICODE_SPACE = r"(?U)[\s\x1c-\x1f]+"

# ``words`` lower-cases and splits at non-word runs, ``spaces`` splits at white space and keeps
# case.  A leading or trailing separator, and a blank line, yield an empty token, which only
# ``words_and_blanks`` keeps.
TOKENISERS = ("words", "words_and_blanks", "spaces")


def _pieces(line: Column, how: str) -> Column:
    if how not in TOKENISERS:
        raise ValueError(f"tokeniser must be one of {TOKENISERS}, not {how!r}")
    return F.split(line, UNICODE_SPACE, -1) if how == "spaces" else F.split(F.lower(line), NON_WORD, -1)


def tokens(line: Column, how: str = "words") -> Column:
    """The tokens of a line, as an array."""
    pieces = _pieces(line, how)
    return pieces if how == "words_and_blanks" else F.filter(pieces, lambda t: t != "")


def explode_words(
    lines: DataFrame, how: str = "words", value: str = "value", kept: Sequence[str] = ()
) -> DataFrame:
    """One row per token, in ``word``, next to the ``kept`` columns.

    Empty tokens are dropped as rows: unlike a filter inside the array this is compiled.
    """
    rows = lines.select(*kept, F.explode(_pieces(F.col(value), how)).alias("word"))
    return rows if how == "words_and_blanks" else rows.where(F.col("word") != "")

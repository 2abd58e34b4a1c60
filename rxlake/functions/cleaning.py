"""Column expressions for cleaning raw text: suppression, number grammar, ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, LongType

# --- fixed values -------------------------------------------------------------
# Text that marks a privacy-suppressed value (trimmed, upper case).
SUPPRESSION_TOKENS = ("", "NULL", "N/A", "NA", "*", "#", "SUPPRESSED")
# Values of the 65+ suppression flag column that mean "suppressed".
GE65_FLAG_TOKENS = ("Y", "*", "#")
# Number grammar, applied after removing thousands commas.
LONG_PATTERN = r"^[+-]?[0-9]+$"
DOUBLE_PATTERN = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)$"
# Default label for a blank or missing state.
UNKNOWN = "UNKNOWN"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number_text(trimmed: str | Column) -> Column:
    """Trimmed text of a number without thousands commas; NULL exactly where the
    value is suppressed (a token in any case, or no text)."""
    value = _col(trimmed)
    return F.when(~F.upper(value).isin(*SUPPRESSION_TOKENS), F.replace(value, F.lit(","), F.lit("")))


def in_grammar(text: str | Column, target: DataType) -> Column:
    """Whether ``number_text`` spells a number of the target type."""
    return _col(text).rlike(LONG_PATTERN if isinstance(target, LongType) else DOUBLE_PATTERN)


def parse_number(text: str | Column, target: DataType) -> Column:
    """The number that ``number_text`` spells; NULL outside the grammar and for more
    digits than the type holds (``try_cast``)."""
    return F.when(in_grammar(text, target), _col(text).try_cast(target))


def safe_divide(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator / denominator`` as double when the denominator is > 0, else NULL."""
    num, den = _col(numerator), _col(denominator)
    return F.when(den > 0, num.cast(DoubleType()) / den.cast(DoubleType())).otherwise(
        F.lit(None).cast(DoubleType())
    )


def default_blank(c: str | Column, default: str = UNKNOWN) -> Column:
    """``coalesce(nullif(c, ''), default)``: label a blank or NULL value."""
    value = _col(c)
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def ge65_suppressed(claims_text: str | Column, cost_text: str | Column, flag: str | Column) -> Column:
    """Three-valued OR over ``number_text`` of both values and the upper-case flag:
    with both values present and a NULL flag the result is NULL."""
    return _col(claims_text).isNull() | _col(cost_text).isNull() | _col(flag).isin(*GE65_FLAG_TOKENS)

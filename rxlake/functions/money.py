"""Order-independent aggregates over doubles.

Floating-point sums depend on the order rows arrive in, so two runs (or two
engines) can disagree in the last bits. Money is summed as exact decimals, and
averages of ratios as whole multiples of a small unit, in decimals wide enough
for any number of rows. Both are the same for any partitioning of the input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType

MONEY = DecimalType(28, 6)
WHOLE = DecimalType(38, 0)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_sum(c: str | Column) -> Column:
    """Exact sum of a money column (six decimals), as double; NULL when all NULL."""
    return F.sum(_col(c).cast(MONEY)).cast(DoubleType())


def scaled(c: str | Column, digits: int = 6) -> Column:
    """A double as a whole number of ``10**-digits`` units.

    The product is rounded in binary (not through a decimal string), so every
    engine maps a value to the same integer."""
    return F.round(_col(c) * F.lit(10**digits)).cast(WHOLE)


def stable_sum(c: str | Column, digits: int = 6) -> Column:
    """Sum of a double column, exact at ``digits`` decimals and order-independent."""
    return F.sum(scaled(c, digits)).cast(DoubleType()) / F.lit(float(10**digits))


def stable_avg(c: str | Column, digits: int = 6) -> Column:
    """Average of a double column, summed exactly at ``digits`` decimals."""
    return stable_sum(c, digits) / F.count(_col(c)).cast(DoubleType())


def stable_stddev(c: str | Column, digits: int = 6) -> Column:
    """Sample standard deviation at ``digits`` decimals, from exact sums of values
    and squares: the same for any partitioning. NULL for fewer than two values."""
    x = scaled(c, digits)
    n = F.count(_col(c)).cast(DoubleType())
    one, two = F.sum(x).cast(DoubleType()), F.sum(x.cast(DecimalType(19, 0)) * x.cast(DecimalType(19, 0))).cast(DoubleType())
    return F.when(n > 1, F.sqrt(F.greatest((two - one * (one / n)) / (n - F.lit(1.0)), F.lit(0.0))) / F.lit(float(10**digits)))

"""Numbers from CSV text, and money sums that do not depend on row order."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# 18 digits before the point; a sum of sums stays within decimal(38, 8).
_AMOUNT = "decimal(26,8)"


def _column(col):
    return F.col(col) if isinstance(col, str) else col


def to_double(col) -> Column:
    """Text to double; NULL where it is not a number."""
    return _column(col).try_cast("double")


def to_int(col) -> Column:
    """Text to int, cutting a plain fraction (`'3.7'` is 3); NULL otherwise.

    Exponents stay NULL. Whole numbers take the first branch, so the pattern
    is only tried on the rest.
    """
    text = _column(col).cast("string")
    cut = F.when(
        text.rlike(r"^\s*[+-]?[0-9]*\.[0-9]*\s*$"), text.try_cast("double").try_cast("int")
    )
    return F.coalesce(text.try_cast("int"), cut)


def amount_parts(col) -> tuple[Column, Column]:
    """A double amount as (decimal, rest), to be summed apart.

    Decimal sums are exact, so they come out the same for every partitioning
    and after every retry. What a decimal cannot hold (NaN, infinity, 1e18 and
    more) stays a double in `rest`, which is NULL for all other rows.
    """
    amount = _column(col)
    exact = amount.try_cast(_AMOUNT)
    return exact, F.when(exact.isNull(), amount)


def amount_total(exact: Column, rest: Column) -> Column:
    """The double total of the two sums made from `amount_parts`."""
    whole = exact.cast("double")
    return F.when(rest.isNull(), whole).otherwise(F.coalesce(whole, F.lit(0.0)) + rest)

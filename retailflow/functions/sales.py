"""Column rules of the sales cleaning step and the reports."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from retailflow.constants import DISCOUNT_RATES, OFFER_FLAGS


def _first_match(pairs, otherwise=None) -> Column:
    """CASE over (condition, value) pairs, the first true one winning."""
    (condition, value), *more = pairs
    case = reduce(lambda c, p: c.when(p[0], p[1]), more, F.when(condition, value))
    return case if otherwise is None else case.otherwise(otherwise)


def discount_rate() -> Column:
    """Rate of the first offer flag that reads as true; 0.0 when none does.

    Every text Spark casts to true counts here ('true', '1', 'yes', 't', ' y ').
    """
    return _first_match(
        [
            (F.col(flag).try_cast("boolean"), F.lit(rate))
            for flag, rate in zip(OFFER_FLAGS, DISCOUNT_RATES)
        ],
        otherwise=F.lit(0.0),
    )


def offer_code() -> Column:
    """Number of the first offer flag that is exactly 'True'; NULL when none is.

    Stricter than `discount_rate`, so a row can carry a discount and no code.
    """
    return _first_match(
        [(F.col(flag) == "True", F.lit(n)) for n, flag in enumerate(OFFER_FLAGS, start=1)]
    )


def offer_label(col, other: str | None = None) -> Column:
    """1..5 as 'offer_1'..'offer_5'; anything else is `other`."""
    code = F.col(col) if isinstance(col, str) else col
    return _first_match(
        [(code == n, F.lit(flag)) for n, flag in enumerate(OFFER_FLAGS, start=1)],
        otherwise=None if other is None else F.lit(other),
    )


def email_trimmed(col) -> Column:
    """Cut whatever follows the first `.com`."""
    return F.regexp_replace(col, r"\.com.*", ".com")


def location_key() -> Column:
    """Key of the location dimension: NULL as soon as one part is NULL."""
    return F.concat(
        F.col("city"), F.lit("-"), F.col("state"), F.lit("-"), F.col("postal_code")
    )


def fact_location_key() -> Column:
    """Key on the fact side: NULL parts are left out, so it is never NULL.

    Where a part is missing the two keys differ and the row finds no location.
    """
    return F.concat_ws("-", "city", "state", "postal_code")

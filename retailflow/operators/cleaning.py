"""Raw sales text to the cleaned wide table.

Every step is row-wise except the removal of exact copies in `clean_sales`,
which is the only shuffle here.
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailflow.constants import (
    MISSING_PLACE,
    NULL_DEFAULTS,
    OFFER_FLAGS,
    TRANSACTION_DATE_FORMAT,
)
from retailflow.functions import discount_rate, email_trimmed, offer_code, to_double
from retailflow.operators.quality import dedup_exact


def fill_defaults(df: DataFrame, defaults: dict[str, str] = NULL_DEFAULTS) -> DataFrame:
    """Replace NULLs by column, skipping columns this drop does not have."""
    present = {name: value for name, value in defaults.items() if name in df.columns}
    return df.na.fill(present) if present else df


def with_discount(df: DataFrame) -> DataFrame:
    return df.withColumn("discounts", discount_rate())


def with_offer_code(df: DataFrame) -> DataFrame:
    """Fold the five offer flags into one `offer` number."""
    return df.withColumn("offer", offer_code()).drop(*OFFER_FLAGS)


def with_address_parts(df: DataFrame) -> DataFrame:
    """City, state and postal code of online sales from `street/city/state/postal`.

    A short address leaves the missing parts NULL; other sales get 'not found'.
    The split is a column of its own so that it runs once per row.
    """
    online = F.col("is_online") == "yes"

    def part(position):
        return F.when(online, F.get("_address", F.lit(position))).otherwise(MISSING_PLACE)

    return (
        df.withColumn("_address", F.split("shipping_address", "/"))
        .withColumns({"city": part(1), "state": part(2), "postal_code": part(3)})
        .drop("_address")
    )


def with_total_paid(df: DataFrame) -> DataFrame:
    gross = to_double("units") * to_double("unit_price")
    return df.withColumn("total_paid", gross - gross * F.col("discounts"))


def clean_email(df: DataFrame, col: str = "cusomter_email") -> DataFrame:
    return df.withColumn(col, email_trimmed(col))


def with_dates(df: DataFrame, as_of: date | str) -> DataFrame:
    """Parse the sale date (NULL if impossible) and stamp the run date."""
    run_date = F.lit(as_of).cast("date")
    return df.withColumns({
        "transaction_date": F.try_to_date("transaction_date", TRANSACTION_DATE_FORMAT),
        "extraction_date": run_date,
        "Extraction_Year": F.year(run_date),
        "Extraction_Month": F.month(run_date),
    })


def derive_sales(df: DataFrame, as_of: date | str) -> DataFrame:
    """The row-wise half of the cleaning.

    Enough on its own for anything that is made distinct afterwards, such as
    the dimensions: those then scan just their own columns.
    """
    return (
        df.transform(with_discount)
        .transform(with_offer_code)
        .transform(with_address_parts)
        .transform(with_total_paid)
        .transform(clean_email)
        .transform(with_dates, as_of)
    )


def clean_sales(
    df: DataFrame, as_of: date | str, dedup: Callable[[DataFrame], DataFrame] = dedup_exact
) -> DataFrame:
    """Defaults, one of each group of exact copies, then the derived columns."""
    return (
        df.transform(fill_defaults)
        .transform(dedup)
        .transform(derive_sales, as_of)
    )

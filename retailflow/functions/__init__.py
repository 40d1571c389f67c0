from .amounts import amount_parts, amount_total, to_double, to_int
from .sales import (
    discount_rate,
    email_trimmed,
    fact_location_key,
    location_key,
    offer_code,
    offer_label,
)

__all__ = [
    "amount_parts",
    "amount_total",
    "discount_rate",
    "email_trimmed",
    "fact_location_key",
    "location_key",
    "offer_code",
    "offer_label",
    "to_double",
    "to_int",
]

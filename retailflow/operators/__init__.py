from .cleaning import (
    clean_email,
    clean_sales,
    derive_sales,
    fill_defaults,
    with_address_parts,
    with_dates,
    with_discount,
    with_offer_code,
    with_total_paid,
)
from .quality import (
    dedup_by_key,
    dedup_exact,
    dedup_spread,
    distinct_count,
    duplicate_count,
    duplicate_groups,
    group_counts,
    null_profile,
    partition_profile,
    partition_sizes,
    row_count,
)
from .reports import (
    agent_product_units,
    avg_amount_by_method,
    best_offer_per_product,
    events_by_type,
    join_agents,
    lowest_online_cities,
    offer_redemptions,
    sold_on,
    sold_since,
    top_products,
)
from .star import (
    agent_dim,
    branch_dim,
    customer_dim,
    date_dim,
    fact,
    location_dim,
    product_dim,
    rows_not_in,
)

__all__ = [
    "agent_dim",
    "agent_product_units",
    "avg_amount_by_method",
    "best_offer_per_product",
    "branch_dim",
    "clean_email",
    "clean_sales",
    "customer_dim",
    "date_dim",
    "dedup_by_key",
    "dedup_exact",
    "dedup_spread",
    "derive_sales",
    "distinct_count",
    "duplicate_count",
    "duplicate_groups",
    "events_by_type",
    "fact",
    "fill_defaults",
    "group_counts",
    "join_agents",
    "location_dim",
    "lowest_online_cities",
    "null_profile",
    "offer_redemptions",
    "partition_profile",
    "partition_sizes",
    "product_dim",
    "row_count",
    "rows_not_in",
    "sold_on",
    "sold_since",
    "top_products",
    "with_address_parts",
    "with_dates",
    "with_discount",
    "with_offer_code",
    "with_total_paid",
]

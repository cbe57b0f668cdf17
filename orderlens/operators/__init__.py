"""Reusable steps between the tables and the reports."""

from orderlens.operators.gaps import longest_gaps
from orderlens.operators.ranking import (
    both_ends,
    first_n,
    nth_per_group,
    numbered,
    top_n_per_group,
)
from orderlens.operators.spend import customer_totals, order_totals, spend_by_customer

__all__ = [
    "both_ends", "customer_totals", "first_n", "longest_gaps", "nth_per_group",
    "numbered", "order_totals", "spend_by_customer", "top_n_per_group",
]

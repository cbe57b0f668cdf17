"""Column expressions shared by the reports."""

from orderlens.functions.amounts import as_double, line_amount, or_zero
from orderlens.functions.dates import as_day, days_between
from orderlens.functions.ordering import ascending, descending

__all__ = [
    "as_day", "as_double", "ascending", "days_between", "descending", "line_amount", "or_zero",
]

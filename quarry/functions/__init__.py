"""Column helpers shared by the operators."""

from quarry.functions.exact import ExactSum, exact_product, exact_sum
from quarry.functions.columns import (
    before_year,
    day_of,
    in_month,
    in_year,
    is_false,
    is_true,
    iso_weekday,
    money,
    on_days,
    pg_weekday,
    to_double,
)

__all__ = [
    "ExactSum", "before_year", "day_of", "exact_product", "exact_sum", "in_month", "in_year", "is_false", "is_true",
    "iso_weekday", "money", "on_days", "pg_weekday", "to_double",
]

from rollwise.functions.categories import big_size_sql, in_category_sql, style_category_sql
from rollwise.functions.scalars import (
    day_literal,
    in_days,
    in_days_sql,
    ratio_sql,
    round_to_long,
    round_to_long_sql,
    upper_sql,
    valid_at,
)

__all__ = [
    "big_size_sql",
    "day_literal",
    "in_category_sql",
    "in_days",
    "in_days_sql",
    "ratio_sql",
    "round_to_long",
    "round_to_long_sql",
    "style_category_sql",
    "upper_sql",
    "valid_at",
]

from rollwise.operators.checks import duplicate_keys
from rollwise.operators.joins import absent_from, salted_join
from rollwise.operators.numbering import number_rows
from rollwise.operators.periods import assign_period, period_columns, period_sums
from rollwise.operators.repeats import repeat_rows, split_copies

__all__ = [
    "absent_from",
    "assign_period",
    "duplicate_keys",
    "number_rows",
    "period_columns",
    "period_sums",
    "repeat_rows",
    "salted_join",
    "split_copies",
]

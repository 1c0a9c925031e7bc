"""DataFrame -> DataFrame operators."""

from panelspark.operators.averages import average_numeric, numeric_columns
from panelspark.operators.leaders import (
    LeaderNames,
    entity_running_totals,
    period_totals,
    quarter_leaders,
    quarter_peak,
    running_totals,
    top_n,
)
from panelspark.operators.panel import in_date_range, lagged_change
from panelspark.operators.periods import monthly_totals, peak_period, sorted_by, with_quarter, with_year_month
from panelspark.operators.profile import distinct_counts, distinct_values, rows_for_key

__all__ = [
    "LeaderNames",
    "average_numeric",
    "distinct_counts",
    "distinct_values",
    "entity_running_totals",
    "in_date_range",
    "lagged_change",
    "monthly_totals",
    "numeric_columns",
    "peak_period",
    "period_totals",
    "quarter_leaders",
    "quarter_peak",
    "rows_for_key",
    "running_totals",
    "sorted_by",
    "top_n",
    "with_quarter",
    "with_year_month",
]

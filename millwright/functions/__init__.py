from millwright.functions.rates import availability_pct, defect_rate, is_high_defect, pct_change, percent_of
from millwright.functions.times import boundary_minutes, deadline, delay_hours, week_start

__all__ = [
    "availability_pct", "boundary_minutes", "deadline", "defect_rate", "delay_hours",
    "is_high_defect", "pct_change", "percent_of", "week_start",
]

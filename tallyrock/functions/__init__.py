"""Column expressions, all made of Spark built-ins."""

from tallyrock.functions.flags import flag, holds, is_high_value, is_suspicious, risk_score
from tallyrock.functions.money import average_amount, total_amount
from tallyrock.functions.text import lower_trim, upper_trim
from tallyrock.functions.times import calendar_parts, to_time

__all__ = [
    "average_amount",
    "calendar_parts",
    "flag",
    "holds",
    "is_high_value",
    "is_suspicious",
    "lower_trim",
    "risk_score",
    "to_time",
    "total_amount",
    "upper_trim",
]

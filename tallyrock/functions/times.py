from pyspark.sql import Column, functions as F


def to_time(text, kind: str = "timestamp") -> Column:
    """Text to a timestamp; text that is no date gives NULL, also under ANSI rules."""
    column = F.col(text) if isinstance(text, str) else text
    return column.try_cast(kind)


def calendar_parts(day) -> dict[str, Column]:
    """Year, month, day of month and ISO week of a date."""
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "week": F.weekofyear(day),
    }

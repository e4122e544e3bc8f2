"""Calendar expressions. Weeks start on Sunday unless asked otherwise."""
from pyspark.sql import Column, functions as F


def _c(x):
    return x if isinstance(x, Column) else F.col(x)


def week_start(d, monday=False) -> Column:
    """First day of the week of a date. Spark's own trunc('week') always means Monday."""
    d = _c(d).cast("date")
    return F.trunc(d, "week") if monday else F.date_sub(d, F.dayofweek(d) - 1)


def month_start(d) -> Column:
    return F.trunc(_c(d), "month")


def grain_start(d, grain: str, monday=False) -> Column:
    """Start of the day, week, month, quarter or year of a date."""
    d = _c(d).cast("date")
    if grain in ("raw", "day", "date"):
        return d
    if grain == "week":
        return week_start(d, monday)
    if grain in ("month", "quarter", "year"):
        return F.trunc(d, grain)
    raise ValueError(f"unknown grain: {grain}")


def date_trunc_safe(part: str, ts) -> Column:
    """The date of a timestamp cut to a calendar part, NULL for NULL."""
    return grain_start(_c(ts), part)


def minutes_between(later, earlier) -> Column:
    """Whole minutes from earlier to later, cut towards zero."""
    return F.timestamp_diff("MINUTE", _c(earlier), _c(later))


def hours_between(later, earlier) -> Column:
    """Whole hours from earlier to later, cut towards zero."""
    return F.timestamp_diff("HOUR", _c(earlier), _c(later))


def micros(ts) -> Column:
    """Microseconds since the epoch."""
    return F.unix_micros(_c(ts).cast("timestamp"))

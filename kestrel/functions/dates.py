"""Date and time column functions (native expressions, codegen-friendly).

Every parse is tolerant (``try_*``): ANSI mode makes plain ``to_timestamp``
raise on bad text, while these return NULL and let the caller decide.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two trip-time text formats and the peak-hour ranges.
HYPHEN_FORMAT = "MM-dd-yyyy HH:mm:ss"        # e.g. 01-31-2017 07:00:00
SLASH_FORMAT = "MM/dd/yyyy hh:mm:ss a"       # e.g. 02/01/2017 05:30:00 PM
PEAK_HOURS = ((7, 9), (17, 20))              # inclusive ranges


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_trip_ts(text) -> Column:
    """Two-format trip time text → TIMESTAMP_NTZ; NULL when neither format parses."""
    t = _c(text)
    return F.coalesce(F.try_to_timestamp(t, F.lit(HYPHEN_FORMAT)),
                      F.try_to_timestamp(t, F.lit(SLASH_FORMAT))).cast("timestamp_ntz")


def in_month(ts, month: int) -> Column:
    """True when the timestamp falls in ``month`` (1..12); unparsable/NULL → False."""
    return F.coalesce(F.month(_c(ts)) == F.lit(month), F.lit(False))


def _is_peak(hour: Column) -> Column:
    cond = None
    for lo, hi in PEAK_HOURS:
        c = hour.between(lo, hi)
        cond = c if cond is None else (cond | c)
    return cond


def peak_time(ts) -> Column:
    """1 in the peak hours, 0 otherwise, −1 when the time is missing/unparsable."""
    t = _c(ts)
    return (F.when(t.isNull(), F.lit(-1))
             .when(_is_peak(F.hour(t)), F.lit(1))
             .otherwise(F.lit(0)))


def text_hour(text) -> Column:
    """Hour of hyphenated date-time text as INT (NULL when absent): the clock's first field."""
    t = _c(text)
    day, clock = F.split_part(t, F.lit(" "), F.lit(1)), F.split_part(t, F.lit(" "), F.lit(2))
    dated = (F.size(F.split(day, "-")) == 3) & (F.size(F.split(clock, ":")) == 3)
    return F.when(dated, F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int"))


def peak_flag_text(text) -> Column:
    """Peak flag read from hyphenated date-time text; unparsable → 0."""
    h = text_hour(text)
    return F.when(_is_peak(h), F.lit(1)).otherwise(F.lit(0))


def is_weekend(ts) -> Column:
    """1 for Saturday/Sunday, else 0 (NULL input → 0)."""
    return F.coalesce(F.dayofweek(_c(ts)).isin(1, 7).cast("int"), F.lit(0))


def quarter_start(label) -> Column:
    """``2000Q1`` → DATE 2000-01-01; other text → NULL."""
    s = _c(label)
    year = F.split_part(s, F.lit("Q"), F.lit(1)).try_cast("int")
    quarter = F.split_part(s, F.lit("Q"), F.lit(2)).try_cast("int")
    return F.when(year.isNotNull() & quarter.between(1, 4), F.make_date(year, quarter * 3 - 2, F.lit(1)))


def parse_month(label) -> Column:
    """``yyyy-MM`` month label → TIMESTAMP_NTZ at the first of the month."""
    return F.try_to_timestamp(_c(label), F.lit("yyyy-MM")).cast("timestamp_ntz")


def parse_date(text) -> Column:
    """ISO date text → DATE (NULL when unparsable)."""
    return _c(text).try_cast("date")


def future_periods(last, horizon: int, months_per_step: int = 1) -> Column:
    """Array of the ``horizon`` period starts following ``last`` (a DATE)."""
    l = _c(last).cast("date")
    if horizon <= 0:
        return F.array().cast("array<date>")
    return F.sequence(F.add_months(l, months_per_step),
                      F.add_months(l, months_per_step * horizon),
                      F.expr(f"make_ym_interval(0, {months_per_step})"))

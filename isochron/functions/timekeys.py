"""Hour arithmetic on TIMESTAMP_NTZ columns.

None of these expressions goes through a zoned timestamp, so results do not
depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date-time format of a reading and the row-key format.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
KEY_HOUR_FORMAT = "yyyyMMddHH"
KEY_PREFIX = "r-"

# The date forms met in readings files, each with the pattern that tells it.
USUAL_FORM = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"  # DATETIME_FORMAT
FILE_DATE_FORMS = (
    (r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}$", "yyyy-MM-dd HH:mm"),
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4} \d{2}:\d{2}$", "dd-MMM-yyyy HH:mm"),
    (r"^\d{2}-[A-Za-z]{3}-\d{4}$", "dd-MMM-yyyy"),
)


def _hours(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), n.cast("int"), F.lit(0), F.lit(0))


def hour_floor(ts: Column) -> Column:
    """Truncate to the hour, staying TIMESTAMP_NTZ."""
    return ts.cast("date").cast("timestamp_ntz") + _hours(F.hour(ts))


def hours_after(ts: Column, hours: int | Column) -> Column:
    n = F.lit(hours) if isinstance(hours, int) else hours
    return ts + _hours(n)


def hour_key(ts: Column) -> Column:
    """Row key ``r-yyyyMMddHH`` of a reading."""
    return F.format_string(
        KEY_PREFIX + "%04d%02d%02d%02d", F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts)
    )


def month_of(ts: Column) -> Column:
    """``yyyy-MM``, by which stored readings are partitioned."""
    return F.substring(ts.cast("string"), 1, 7)


def reading_time(date_cell: Column, row_key: Column, fmt: str = DATETIME_FORMAT) -> Column:
    """Reading time from the date cell or, where that is absent, from the row key."""
    return F.coalesce(
        F.to_timestamp_ntz(date_cell, F.lit(fmt)),
        F.to_timestamp_ntz(F.substr(row_key, F.lit(len(KEY_PREFIX) + 1)), F.lit(KEY_HOUR_FORMAT)),
    )


def shown_time(ts: Column, fmt: str = DATETIME_FORMAT) -> Column:
    """The time as text. Formats but the usual one go through the session's time zone, which should be UTC then."""
    if fmt == DATETIME_FORMAT:
        return F.substring(ts.cast("string"), 1, 19)
    return F.date_format(ts, fmt)


def file_time(text: Column) -> Column:
    """Reading time from the date text of a file. Text of no known form is an error."""
    usual = F.to_timestamp_ntz(text, F.lit(DATETIME_FORMAT))
    parsed = usual
    for pattern, fmt in reversed(FILE_DATE_FORMS):
        parsed = F.when(text.rlike(pattern), F.to_timestamp_ntz(text, F.lit(fmt))).otherwise(parsed)
    # In the usual form a cast reads the same, at a fraction of what a formatter costs.
    return F.when(text.rlike(USUAL_FORM), text.cast("timestamp_ntz")).otherwise(parsed)


def ntz_literal(moment: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal; a plain ``lit(datetime)`` is zoned and would block Parquet pushdown."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    return F.expr(f"TIMESTAMP_NTZ '{moment:%Y-%m-%d %H:%M:%S.%f}'")

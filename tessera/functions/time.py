"""Time helpers that keep wall-clock (TIMESTAMP_NTZ) values free of the session time zone.

Python datetimes passed through ``F.lit`` become instants in the Python
process's zone; ``date_trunc`` and ``try_to_timestamp`` work in the session
zone. These helpers avoid both, so results do not depend on where the job runs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _text(value: dt.date | dt.datetime | str) -> str:
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    if isinstance(value, dt.date):
        return f"{value.isoformat()} 00:00:00"
    return str(value)


def ntz_lit(value: dt.date | dt.datetime | str) -> Column:
    """A wall-clock timestamp literal."""
    return F.lit(_text(value)).cast("timestamp_ntz")


def literal_like(df: DataFrame, column: str, value) -> Column:
    """A timestamp/date literal of the column's own type (wall-clock for NTZ)."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return ntz_lit(value)
    if isinstance(dtype, T.DateType):
        return F.lit(_text(value)[:10]).cast("date")
    return F.lit(_text(value)).cast("timestamp")


def parse_ntz(text: Column, fmt: str | None = None) -> Column:
    """String → TIMESTAMP_NTZ; NULL when it does not parse (no session-zone round trip)."""
    if fmt:
        ok = F.try_to_timestamp(text, F.lit(fmt)).isNotNull()
        return F.when(ok, F.to_timestamp_ntz(text, F.lit(fmt)))
    return F.when(F.try_to_timestamp(text).isNotNull(), F.to_timestamp_ntz(text))


def trunc_ntz(ts: Column, unit: str) -> Column:
    """Start of the day/week (Monday)/month/quarter/year as TIMESTAMP_NTZ."""
    d = F.to_date(ts)
    if unit == "day":
        return d.cast("timestamp_ntz")
    return F.trunc(d, unit).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed wall-clock seconds from calendar fields (no zone conversion, so a
    start inside a daylight-saving gap of the session zone is not shifted)."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("double")
    hours = (F.hour(end) - F.hour(start)).cast("double")
    minutes = (F.minute(end) - F.minute(start)).cast("double")
    secs = (F.date_part(F.lit("SECOND"), end) - F.date_part(F.lit("SECOND"), start)).cast("double")
    return days * 86400 + hours * 3600 + minutes * 60 + secs


def wall_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a TIMESTAMP_NTZ without any zone conversion."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)

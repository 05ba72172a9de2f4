"""Instants shown as wall-clock text of a zone. The session zone must be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import as_column

# The two ways points in time are written.
MINUTE_FORMAT = "yyyy-MM-dd HH:mm"
STAMP_FORMAT = "dd.MM.yyyy HH:mm"


def instant(c: Column | str) -> Column:
    """ISO text with an offset as an instant; text that is no time fails the run."""
    return F.to_timestamp(as_column(c))


def wall_clock(c: Column | str, zone: str) -> Column:
    """An instant as it reads on a clock of the zone."""
    return F.from_utc_timestamp(as_column(c), zone)


def minute_text(c: Column | str, zone: str, pattern: str = MINUTE_FORMAT) -> Column:
    return F.date_format(wall_clock(c, zone), pattern)


def iso_minute_text(c: Column | str, zone: str) -> Column:
    """ISO text to zone-local minute text."""
    return minute_text(instant(c), zone)


def now_text(zone: str) -> Column:
    """Current time of the zone as a report stamp."""
    return minute_text(F.current_timestamp(), zone, STAMP_FORMAT)

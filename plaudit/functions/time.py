"""TIMESTAMP_NTZ <-> TIMESTAMP without depending on the session time zone.

The driver tables store wall-clock times (TIMESTAMP_NTZ); ``withWatermark``
needs TIMESTAMP. Both conversions read the wall clock as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _epoch_ntz() -> Column:
    # From text: a Python datetime literal would pass through the session
    # time zone on its way to TIMESTAMP_NTZ.
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def ntz_to_instant(ts: Column) -> Column:
    """Wall-clock TIMESTAMP_NTZ → the TIMESTAMP with that UTC wall clock."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), ts))


def instant_to_ntz(ts: Column) -> Column:
    """TIMESTAMP → TIMESTAMP_NTZ holding its UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), _epoch_ntz())

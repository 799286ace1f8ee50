"""Local hour of day from UTC time plus a per-row offset.

The reference adds the offset to the epoch and reads the hour in the
machine's zone; here the hour is computed in UTC with exact integer
arithmetic, so the answer does not depend on the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_HOUR = 3_600_000
MS_PER_DAY = 86_400_000


def local_hour_from_epoch_ms(epoch_ms: str | Column, offset_seconds: str | Column) -> Column:
    ms = F.col(epoch_ms) if isinstance(epoch_ms, str) else epoch_ms
    off = F.col(offset_seconds) if isinstance(offset_seconds, str) else offset_seconds
    local_ms = ms.cast("bigint") + off.cast("bigint") * 1000
    return F.floor(F.pmod(local_ms, F.lit(MS_PER_DAY)) / MS_PER_HOUR).cast("bigint")


def second_of_day(ts: str | Column) -> Column:
    """Whole seconds since midnight of a TIMESTAMP_NTZ."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return (F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)).cast("int")


def local_hour_from_second_of_day(sec: str | Column, offset_seconds: str | Column) -> Column:
    """Hour of ``time-of-day + offset``.  With whole-second offsets the fraction
    of a second never moves the hour, so whole seconds are enough."""
    s_ = F.col(sec) if isinstance(sec, str) else sec
    off = F.col(offset_seconds) if isinstance(offset_seconds, str) else offset_seconds
    return F.floor(F.pmod(s_.cast("bigint") + off.cast("bigint"), F.lit(86_400)) / 3600).cast("bigint")

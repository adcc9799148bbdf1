"""Latest published forecast announcement as of a moment."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# First announcement of the day, interval and publishing lag, in minutes.
SCHEDULES = {
    "forecast": (120, 180, 15),        # 02:00, 05:00, ... 23:00
    "ultra_forecast": (30, 60, 20),    # every hour at :30
    "nowcast": (0, 60, 45),            # every hour at :00
}
_KST_MINUTES = 9 * 60
_DAY = 24 * 60


def latest_announcement(now: Column, operation: str, wall_clock: bool = False) -> Column:
    """``STRUCT<base_date, base_time>`` (``yyyyMMdd``, ``HHmm``) of the newest announcement
    whose publishing lag has passed at ``now``.

    ``now`` is an instant (TIMESTAMP), or with ``wall_clock`` a zone-less Korean wall-clock
    time (TIMESTAMP_NTZ). Every schedule repeats daily, so the slot is found by rounding down
    to the interval: no join and no list of slots.
    """
    if operation not in SCHEDULES:
        raise ValueError(f"unknown operation {operation!r}; one of {list(SCHEDULES)}")
    first, step, lag = SCHEDULES[operation]
    if wall_clock:
        minutes = (F.unix_date(now.cast("date")).cast("bigint") * _DAY
                   + F.hour(now) * 60 + F.minute(now))
    else:
        minutes = F.floor(F.unix_micros(now) / 60_000_000) + _KST_MINUTES
    # A publishing lag in whole minutes: seconds within the minute cannot change the slot.
    slot = F.floor((minutes - lag - first) / step) * step + first
    day = F.date_from_unix_date(F.floor(slot / _DAY).cast("int"))
    minute = F.pmod(slot, F.lit(_DAY))
    clock = F.lpad((F.floor(minute / 60) * 100 + minute % 60).cast("string"), 4, "0")
    return F.struct(F.date_format(day, "yyyyMMdd").alias("base_date"), clock.alias("base_time"))

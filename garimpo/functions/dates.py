"""Dates in loose notations, and the boundaries of incremental windows. The current time is always a parameter."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: dates without a zone are written three hours behind UTC, without daylight saving.
LOCAL_OFFSET_HOURS = -3
LOCAL_OFFSET = "-03:00"

_ISO = r"^(\d{4})-(\d{2})-(\d{2})(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,](\d{1,9}))?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?)?$"


def _part(text: Column, k: int, default: str) -> Column:
    found = F.regexp_extract(text, _ISO, k)
    return F.when(found == "", default).otherwise(found)


def parse_datetime(text: Column) -> Column:
    """The instant (session zone UTC) of an ISO date or time, of yyyyMMdd or of yyyyMMddHHmmss; null for anything else.

    Without an offset the text is taken as UTC-3.
    """
    t = F.trim(text)
    offset = F.regexp_extract(t, _ISO, 8)
    zone = F.when(offset == "", LOCAL_OFFSET).when(offset == "Z", "+00:00").when(F.length(offset) == 3, F.concat(offset, F.lit(":00"))).when(F.length(offset) == 5, F.concat(F.substring(offset, 1, 3), F.lit(":"), F.substring(offset, 4, 2))).otherwise(offset)
    written = F.concat(_part(t, 1, ""), F.lit("-"), _part(t, 2, ""), F.lit("-"), _part(t, 3, ""), F.lit(" "), _part(t, 4, "00"), F.lit(":"), _part(t, 5, "00"), F.lit(":"), _part(t, 6, "00"), F.lit("."), F.rpad(F.regexp_extract(t, _ISO, 7), 6, "0"), zone)
    iso = F.when(t.rlike(_ISO), F.try_to_timestamp(written, F.lit("yyyy-MM-dd HH:mm:ss.SSSSSSxxx")))
    plain = F.when(t.rlike(r"^\d{14}$"), F.try_to_timestamp(F.concat(t, F.lit(LOCAL_OFFSET)), F.lit("yyyyMMddHHmmssxxx")))
    day = F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(F.concat(t, F.lit("000000" + LOCAL_OFFSET)), F.lit("yyyyMMddHHmmssxxx")))
    return F.coalesce(iso, plain, day)


def window_boundaries(now: datetime, checkpoint: datetime | None = None, *, lookback: int = 30, forward: int = 60, overlap: int = 1, initial: int = 2) -> dict[str, str]:
    """The yyyyMMdd bounds of an incremental run: today, start of publications, end of proposals, start of updates.

    `now` and `checkpoint` are instants; days are those at UTC-3. Updates begin
    `overlap` days before the checkpoint, or `initial` days ago without one.
    """
    zone = timezone(timedelta(hours=LOCAL_OFFSET_HOURS))
    today = now.astimezone(zone).date()
    start = checkpoint.astimezone(zone).date() - timedelta(days=overlap) if checkpoint else today - timedelta(days=initial)
    days = {"today": today, "publication_start": today - timedelta(days=lookback), "proposal_end": today + timedelta(days=forward), "update_start": start}
    return {name: day.strftime("%Y%m%d") for name, day in days.items()}


def in_daytime(ts: Column, zone: str = "America/Los_Angeles", first: int = 8, last: int = 19) -> Column:
    """Whether an instant falls into the hours from `first` to before `last` of the zone."""
    return F.hour(F.from_utc_timestamp(ts, zone)).between(first, last - 1)

"""Time predicates; ``as_of`` is always given, never the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL {n} DAY")


def parse(x: Column) -> Column:
    """A timestamp from ISO text, or null."""
    return F.try_to_timestamp(x)


def _utc(x: Column) -> Column:
    """The clock in UTC at a timestamp, whatever the session's zone; times without a zone are read in the session's."""
    return F.to_utc_timestamp(x.cast("timestamp"), F.current_timezone())


def iso(x: Column) -> Column:
    return F.date_format(_utc(x), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def utc_day(x: Column) -> Column:
    """The day of a timestamp in UTC."""
    return F.to_date(_utc(x))


def pushed_today(at: Column, as_of: Column) -> Column:
    """Whether both are on one day in UTC."""
    return F.coalesce(utc_day(at) == utc_day(as_of), F.lit(False))


def recently_active(at: Column, as_of: Column, days: int = rules.ACTIVE_DAYS) -> Column:
    """Less than ``days`` ago; 0 days turns it off."""
    return F.coalesce(at > as_of - _days(days), F.lit(False)) if days > 0 else F.lit(False)


def seen_within(last_seen: Column, added: Column, as_of: Column, days: int = rules.GRACE_DAYS) -> Column:
    """``days`` ago at most, by the last stamp, else by the first."""
    return F.coalesce(F.coalesce(last_seen, added) >= as_of - _days(days), F.lit(False))


def needs_resend(emailed_at: Column, as_of: Column, days: int = rules.LINK_DAYS) -> Column:
    """Never emailed (null or blank), or emailed so long ago that the link has run out.

    Text that is no time is neither.
    """
    text = emailed_at.cast("string")
    return (F.coalesce(text, F.lit("")) == "") | F.coalesce(F.try_to_timestamp(text) + _days(days) <= as_of, F.lit(False))

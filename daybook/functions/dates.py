"""Dates and load times to and from text, independent of the session time zone."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def parse_day(text: Column) -> Column:
    """``yyyy-MM-dd`` to a date; anything else, also ``2024-1-5``, gives null.

    The cast alone would take shorter parts, blanks and a time as well; a
    formatter would be strict too, but slower.
    """
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}\z"), text.try_cast("date"))


def parse_instant(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a zone-less timestamp; anything else gives null."""
    return F.when(
        text.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"), text.try_cast("timestamp_ntz")
    )


def day_text(day: Column) -> Column:
    """A date's text form is ``yyyy-MM-dd``."""
    return day.cast("string")


def instant_text(instant: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``. Going through text keeps a zone-less time as it
    is; a formatter would take it through the session's zone first."""
    return F.substring(instant.cast("timestamp_ntz").cast("string"), 1, 19)


def run_time(moment: dt.datetime) -> Column:
    """The job's own time, passed in so that every action sees the same one."""
    return F.lit(moment.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")

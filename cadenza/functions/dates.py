"""Release dates of three precisions, windows, epochs and the debounce rule, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_release_date(raw: Column) -> Column:
    """Year, year-month and full dates as a date string; what isn't one of these forms is null.

    Parts are padded with 01.  Months and days are not range-checked and a full date is kept as it is written, but each part must be a
    number above zero.
    """
    year = F.when(raw.rlike(r"^[0-9]{4}$") & (F.try_to_number(raw, F.lit("9999")) > 0), F.concat(raw, F.lit("-01-01")))
    positive = lambda c: c.rlike("^[0-9]*[1-9][0-9]*$")
    parts = F.split(raw, "-")
    month = F.when((F.size(parts) == 2) & positive(parts[0]) & positive(parts[1]), F.concat(raw, F.lit("-01")))
    day = F.when((F.size(parts) == 3) & (F.char_length(parts[0]) == 4) & positive(parts[0]) & positive(parts[1]) & positive(parts[2]), raw)
    return F.when(F.char_length(raw) == 4, year).when(F.char_length(raw) == 7, month).otherwise(day)


def freshness_key(raw: Column) -> Column:
    """A ten-character key that sorts like the date; empty and null sort first."""
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("0000-01-01")).otherwise(F.substring(F.concat(raw, F.lit("-01-01")), 1, 10))


def full_date(raw: Column) -> Column:
    """The date if all ten characters are there and name one, else null."""
    return F.when(raw.rlike(r"^\d{4}-\d{2}-\d{2}$"), raw.try_cast("date"))


def in_window(raw: Column, today: Column, horizon_days: int) -> Column:
    """Whether a full date lies between today and the horizon, both ends included; false for anything else."""
    day = full_date(raw)
    return F.coalesce(day.between(today, F.date_add(today, horizon_days)), F.lit(False))


def parse_instant(raw: Column) -> Column:
    """An ISO timestamp, null if it isn't one."""
    return F.try_to_timestamp(raw)


def debounced(now: Column, last_write: Column, seconds: int = 60) -> Column:
    """Whether less than ``seconds`` passed since the last write; never before a first write."""
    return F.coalesce(F.unix_timestamp(now) - F.unix_timestamp(last_write) < seconds, F.lit(False))

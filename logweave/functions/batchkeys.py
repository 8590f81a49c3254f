"""Batch-key expressions for calendar batching.

The key is read with less parsing than the full parser: the text between the
first '[' and the first ']' of the line, cut at its first ':', must be a
``dd/MMM/yyyy`` date (SMART: day clamped to the month's last day).  A line
without such a date gets the key ``__malformed__``; a malformed line *with* a
readable date is counted in that month / week.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from logweave.constants import (FIXED_BATCH_PREFIX, MALFORMED_BATCH_KEY,
                                MONTH_KEY_FORMAT, STRATEGY_ALIASES,
                                WEEK_KEY_FORMAT)
from logweave.functions.parse import (DATE_PART_REGEX, _clamped_date, _int,
                                      _month_number, _year)


def normalise_strategy(name: str | None) -> str:
    """``monthly``/``month`` and ``weekly``/``week``; anything else is fixed."""
    return STRATEGY_ALIASES.get((name or "").lower(), "fixed")


def batch_date(line: Column) -> Column:
    """Calendar date used for MONTHLY / WEEKLY keys, NULL when unreadable."""
    # byte offsets of the first '[' and the first ']' (the line's length if absent)
    size = F.octet_length(line)
    open_at = F.octet_length(F.substring_index(line, "[", 1))
    close_at = F.octet_length(F.substring_index(line, "]", 1))
    inner = F.when((open_at < size) & (close_at < size) & (close_at > open_at),
                   F.substring(line.cast("binary"), open_at + 2, close_at - open_at - 1)
                   .cast("string"))
    date_txt = F.substring_index(inner, ":", 1)
    shape_ok = date_txt.rlike(DATE_PART_REGEX)
    day = _int(F.substring(date_txt, 1, 2))
    month = _month_number(F.substring(date_txt, 4, 3))
    year = _year(F.substring(date_txt, 8, 64))
    ok = F.coalesce(shape_ok & day.between(1, 31) & year.between(1, 9999), F.lit(False))
    return _clamped_date(year.cast("int"), month, day, ok)


def month_key(date: Column) -> Column:
    key = F.format_string(MONTH_KEY_FORMAT, F.year(date), F.month(date))
    return F.when(date.isNotNull(), key).otherwise(F.lit(MALFORMED_BATCH_KEY))


def week_key(date: Column) -> Column:
    key = F.format_string(WEEK_KEY_FORMAT, F.extract(F.lit("YEAROFWEEK"), date),
                          F.weekofyear(date))
    return F.when(date.isNotNull(), key).otherwise(F.lit(MALFORMED_BATCH_KEY))


def calendar_key(strategy: str, date: Column) -> Column:
    strategy = normalise_strategy(strategy)
    if strategy == "monthly":
        return month_key(date)
    if strategy == "weekly":
        return week_key(date)
    raise ValueError("calendar keys exist only for monthly / weekly batching")


def fixed_key(batch_number: Column) -> Column:
    return F.concat(F.lit(FIXED_BATCH_PREFIX), batch_number.cast("string"))

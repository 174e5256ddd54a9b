"""Calendar arithmetic, as SQL over the names of date columns."""

from __future__ import annotations


def inclusive_days(start: str, end: str) -> str:
    """Days of a closed date range; a range of one day has length 1."""
    return f"datediff({end}, {start}) + 1"


def completed_years(born: str, on: str) -> str:
    """Birthdays passed between two dates, negative when ``on`` lies before ``born``."""
    return f"floor(months_between({on}, {born}) / 12)"


def first_date(*columns: str) -> str:
    """First of several columns that holds a date.

    Accepts dates, timestamps (their day in the session time zone) and text; text that is
    no date counts as absent, so the next column gets its turn.
    """
    return f"coalesce({', '.join(f'try_cast({c} AS DATE)' for c in columns)})"

"""Month buckets, labels and the optional time window. Zone-free types only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The day of a ledger row, in ledgers that are partitioned by it.
DAY_COLUMN = "CREATED_DAY"
EVENT_TIME_FORMAT = "dd.MM.yyyy HH:mm:ss"


def month_start(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def month_label(month: Column) -> Column:
    """Month name. Carries no year: keep the month date as the sort key."""
    return F.date_format(month, "MMMM")


def month_label_padded(month: Column) -> Column:
    """Month name blank-padded to nine characters."""
    return F.rpad(month_label(month), 9, " ")


def event_time_label(moment: Column) -> Column:
    """``DD.MM.YYYY HH24:MI:SS``, from the text of the zone-free timestamp.

    ``date_format`` would read the time in the session's zone and move hours that a clock change skips.
    """
    text = moment.cast("timestamp_ntz").cast("string")
    day = F.concat_ws(".", text.substr(9, 2), text.substr(6, 2), text.substr(1, 4))
    return F.when(text.isNotNull(), F.concat(day, F.lit(" "), text.substr(12, 8)))


def event_time(text: str) -> Column:
    """A ``DD.MM.YYYY HH24:MI:SS`` parameter; text of another form raises."""
    return F.to_timestamp_ntz(F.lit(text), F.lit(EVENT_TIME_FORMAT))


def window_predicate(moment: Column, start: str | None, end: str | None) -> Column | None:
    """Closed window, or ``None`` for no filter.

    Without a start there is no filter, whatever the end. A start without an end keeps no row.
    """
    if not start:
        return None
    if not end:
        return F.lit(False)
    return moment.between(event_time(start), event_time(end))

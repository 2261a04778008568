"""Date/time expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from rollcall.functions.text import _c

# The two ISO-8601 UTC layouts the directory returns
# (with and without a fraction of a second).
ISO_WITH_FRACTION = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ISO_PLAIN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
EPOCH = "1970-01-01 00:00:00"


def active_on(as_of: date, start, end) -> Column:
    """Closed interval test; a NULL bound means not active."""
    return F.lit(as_of).between(_c(start), _c(end))


def open_end(end, fallback) -> Column:
    """Open-ended leave date takes the term end."""
    return F.coalesce(_c(end), _c(fallback))


def mmddyy(c) -> Column:
    """date → 'MMddyy'."""
    return F.date_format(_c(c), "MMddyy")


def parse_iso_timestamp(c, missing_as_epoch: bool = True) -> Column:
    """try the fraction layout, then the plain one.

    Missing text → 1970-01-01 (when asked); present but unparsable → NULL,
    which callers test with :func:`iso_unparsable` to quarantine the row.
    """
    col = _c(c)
    # The layouts end in a literal 'Z' (UTC); with the session in UTC the wall
    # clock is kept as a zone-less timestamp.
    parsed = F.coalesce(F.try_to_timestamp(col, F.lit(ISO_WITH_FRACTION)),
                        F.try_to_timestamp(col, F.lit(ISO_PLAIN))).cast("timestamp_ntz")
    if missing_as_epoch:
        return F.when(col.isNull(), F.lit(EPOCH).cast("timestamp_ntz")).otherwise(parsed)
    return parsed


def iso_unparsable(c) -> Column:
    col = _c(c)
    return col.isNotNull() & F.coalesce(F.try_to_timestamp(col, F.lit(ISO_WITH_FRACTION)),
                                        F.try_to_timestamp(col, F.lit(ISO_PLAIN))).isNull()


def iso_render(c) -> Column:
    """F16: timestamp → ISO text for JSON payloads."""
    return F.date_format(_c(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")

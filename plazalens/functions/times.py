"""Clock fields of posts and raw files. All results are wall-clock values in UTC, whatever the session zone is."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Layout of the feed's creation time after its weekday, and of the hour in raw file names
CREATED_AT = "MMM dd HH:mm:ss Z yyyy"
FILE_HOUR = "dd-MM-yyyy-HH"


def as_utc(instant: Column) -> Column:
    return F.to_utc_timestamp(instant, F.current_timezone()).cast("timestamp_ntz")


def parse_created_at(c: Column) -> Column:
    """``Wed Oct 26 14:03:59 +0000 2022`` as a timestamp; text of any other shape gives null."""
    return as_utc(F.try_to_timestamp(F.substring(c, 5, 64), F.lit(CREATED_AT)))


def hour_of(c: Column) -> Column:
    return F.date_trunc("hour", c).cast("timestamp_ntz")


def short_date(ts: Column) -> Column:
    return F.date_format(ts, "dd/MM/yy")


def iso_ticks(ts: Column) -> Column:
    """ISO time with seven fraction digits and a ``Z``."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'")


def file_hour(name: Column) -> Column:
    """Hour named by a raw file, null when the name holds none."""
    found = F.regexp_extract(name, "([0-9]+-[0-9]+-[0-9]+-[0-9]+)", 1)
    return as_utc(F.try_to_timestamp(F.when(found != "", found), F.lit(FILE_HOUR)))


def hours_between(earlier: Column, later: Column) -> Column:
    return F.timestamp_diff("SECOND", earlier, later) / F.lit(3600.0)

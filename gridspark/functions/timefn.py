"""Time columns. Wall-clock arithmetic only, so timestamp and timestamp_ntz give the same answer."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 86400
QUARTER_HOUR = 900


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def wall_seconds(ts: Column | str) -> Column:
    """Seconds since 1970-01-01 on the column's own wall clock (long)."""
    if isinstance(ts, str):
        return F.expr(f"unix_date(to_date({ts})) * {DAY}L + hour({ts}) * {HOUR} + minute({ts}) * 60 + second({ts})")
    days = F.unix_date(F.to_date(ts)).cast("long")
    return days * DAY + F.hour(ts) * HOUR + F.minute(ts) * 60 + F.second(ts)


def slot_of(ts: Column | str, step: int = HOUR) -> Column:
    """Number of the grid step that holds `ts`; consecutive steps have consecutive numbers."""
    return F.floor(wall_seconds(ts) / step)


def slot_ts(slot: Column | str, step: int = HOUR) -> Column:
    """Start of a grid step as timestamp_ntz."""
    if isinstance(slot, str):
        return F.expr(f"timestampadd(SECOND, {slot} * {step}, TIMESTAMP_NTZ '1970-01-01 00:00:00')")
    return F.timestamp_add("SECOND", slot * step, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def parse_hour(text: Column | str) -> Column:
    """`YYYYMMDDTHHZ` or `YYYYMMDDTHH-08` to an instant; NULL when malformed."""
    return F.try_to_timestamp(_c(text), F.lit("yyyyMMdd'T'HHX"))


def format_hour(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd'T'HH'Z'")


def hour_timestamp(year: Column | str, month: Column | str, day: Column | str, hour: Column | str) -> Column:
    """Hour timestamp from its parts; NULL when the parts are not a valid date."""
    return F.try_make_timestamp_ntz(_c(year), _c(month), _c(day), _c(hour), F.lit(0), F.lit(0))


def period_start(period: Column | str, freq: Column | str) -> Column:
    """First day of an annual (2016), monthly (201603) or quarterly (2016Q1) period; NULL when malformed."""
    period, freq = _c(period), _c(freq)
    year = F.substring(period, 1, 4).try_cast("int")
    month = F.substring(period, 5, 2).try_cast("int")
    quarter = F.regexp_extract(period, r"Q([1-4])$", 1).try_cast("int")
    first = (
        F.when(freq == "A", F.lit(1))
        .when(freq == "M", F.when(month.between(1, 12), month))
        .when(freq == "Q", quarter * 3 - 2)
    )
    return F.when(year.isNotNull() & first.isNotNull(), F.make_date(year, first, F.lit(1)))


def meter_time(text: Column | str) -> Column:
    """`01JAN11:00:15:00` to a wall-clock timestamp; NULL when malformed."""
    return F.try_to_timestamp(_c(text), F.lit("ddMMMyy:HH:mm:ss")).cast("timestamp_ntz")


def to_local(ts: Column | str, zone: str = "US/Pacific") -> Column:
    """UTC wall clock to local wall clock (timestamp_ntz)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), _c(ts).cast("timestamp_ntz"))


def is_weekend(ts: Column | str) -> Column:
    return F.weekday(_c(ts)) >= 5


def is_leap(ts: Column | str) -> Column:
    year = F.year(_c(ts))
    return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)


def calendar_features(ts: Column | str) -> dict[str, Column]:
    """Hour, weekday (Monday 0) and day of year, each scaled to start at 0 and end at 1."""
    ts = _c(ts)
    return {
        "hour_frac": F.hour(ts) / F.lit(23.0),
        "week_frac": F.weekday(ts) / F.lit(6.0),
        "year_frac": F.dayofyear(ts) / (F.lit(364.0) + is_leap(ts).cast("int")),
    }


def half_open(ts: Column | str, after: str, until: str) -> Column:
    """Slice `(after, until]`."""
    ts = _c(ts)
    return (ts > F.lit(after).cast("timestamp_ntz")) & (ts <= F.lit(until).cast("timestamp_ntz"))


def partial_date_slice(ts: Column | str, start: str, end: str | None = None) -> Column:
    """`2016`, `2016-07` or `2016-07-03` cover the whole unit; `end` is inclusive of its whole unit."""
    ts = _c(ts)
    end = end or start
    unit = {4: "YEAR", 7: "MONTH", 10: "DAY"}[len(end)]
    pad = "-01-01"
    lo = F.lit(start + pad[len(start) - 4:] if len(start) < 10 else start).cast("date")
    hi = F.lit(end + pad[len(end) - 4:] if len(end) < 10 else end).cast("date")
    after = F.timestamp_add(unit, F.lit(1), hi.cast("timestamp_ntz"))
    return (ts >= lo.cast("timestamp_ntz")) & (ts < after)

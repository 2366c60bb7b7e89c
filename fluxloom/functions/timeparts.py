"""Civil time, calendar and binning expressions.

All of them work on TIMESTAMP_NTZ and never consult the session time zone:
values pass through ``DATE`` and integer arithmetic, because ``date_trunc``,
``unix_timestamp`` and ``date_format`` would convert to zoned timestamps.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86_400


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _epoch_date() -> Column:
    return F.lit("1970-01-01").cast("date")


def epoch_day(ts) -> Column:
    """Days since 1970-01-01."""
    return F.datediff(F.to_date(_c(ts)), _epoch_date())


def _since(ts, unit_type: str) -> Column:
    """Time since year 1 as a number of seconds; never negative, so whole seconds are floors."""
    origin = F.lit("0001-01-01 00:00:00").cast("timestamp_ntz")
    return (_c(ts) - origin).cast("interval second").cast(unit_type)


#: Seconds from 0001-01-01 to 1970-01-01.
_YEAR_1_TO_1970 = 719_162 * DAY_SECONDS


def epoch_seconds(ts) -> Column:
    """Whole seconds since 1970-01-01 00:00 on the timestamp's own clock."""
    return _since(ts, "bigint") - F.lit(_YEAR_1_TO_1970)


def epoch_micros(ts) -> Column:
    """Microseconds since 1970-01-01 00:00 on the timestamp's own clock."""
    return (_since(ts, "decimal(18,6)") * 1_000_000).cast("bigint") - F.lit(_YEAR_1_TO_1970 * 1_000_000)


def seconds_between(start, end) -> Column:
    """Seconds from one stamp to another, with fraction."""
    return (_c(end) - _c(start)).cast("interval second").cast("decimal(18,6)").cast("double")


def _epoch_ts() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def plus_seconds(ts, seconds) -> Column:
    """Timestamp moved by a (fractional) number of seconds."""
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def ts_from_seconds(seconds) -> Column:
    s = _c(seconds)
    whole_days = F.floor(s / DAY_SECONDS)
    return _epoch_ts() + F.make_dt_interval(
        whole_days.cast("int"), F.lit(0), F.lit(0), s - whole_days * DAY_SECONDS
    )


def ts_from_micros(micros) -> Column:
    m = _c(micros)
    whole_days = F.floor(m / F.lit(DAY_SECONDS * 1_000_000))
    rest = (m - whole_days * F.lit(DAY_SECONDS * 1_000_000)).cast("decimal(20,6)")
    return _epoch_ts() + F.make_dt_interval(
        whole_days.cast("int"), F.lit(0), F.lit(0), rest / F.lit(1_000_000).cast("decimal(8,0)")
    )


def day_start(ts) -> Column:
    """Midnight that opens the day of ``ts``."""
    return F.to_date(_c(ts)).cast("timestamp_ntz")


def floor_day(ts) -> Column:
    return day_start(ts)


def ceil_day(ts) -> Column:
    """Next midnight, or ``ts`` itself when it is one."""
    t = _c(ts)
    return F.when(t == day_start(t), t).otherwise(F.date_add(F.to_date(t), 1).cast("timestamp_ntz"))


def is_leap_year(year) -> Column:
    y = _c(year)
    return ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)


def ts_from_ydh(year, doy, hour) -> Column:
    """Timestamp from year, day of year and decimal hour (hour 24 is next midnight)."""
    first = F.make_date(_c(year), F.lit(1), F.lit(1))
    day = F.date_add(first, _c(doy).cast("int") - 1).cast("timestamp_ntz")
    return plus_seconds(day, F.round(_c(hour) * 3600))


def decimal_hour(ts) -> Column:
    t = _c(ts)
    return F.hour(t) + F.minute(t) / 60.0


def end_label_hour(ts) -> Column:
    """Decimal hour 0.5 … 24: midnight closes the day before."""
    h = decimal_hour(ts)
    return F.when(h == 0, F.lit(24.0)).otherwise(h)


def end_label_date(ts) -> Column:
    t = _c(ts)
    return F.when(decimal_hour(t) == 0, F.date_sub(F.to_date(t), 1)).otherwise(F.to_date(t))


def parse_hhmm(text) -> Column:
    """``HHmm`` digits to decimal hours."""
    t = F.lpad(_c(text).cast("string"), 4, "0")
    return F.substring(t, 1, 2).try_cast("int") + F.substring(t, 3, 2).try_cast("int") / 60.0


def hhmm_clock(text) -> Column:
    """``HHmm`` digits to ``HH:mm:00``."""
    return F.regexp_replace(F.lpad(_c(text).cast("string"), 4, "0"), r"^(..)(..)$", "$1:$2:00")


def parse_yyyymmdd(text) -> Column:
    t = F.lpad(_c(text).cast("string"), 8, "0")
    return F.make_date(
        F.substring(t, 1, 4).try_cast("int"),
        F.substring(t, 5, 2).try_cast("int"),
        F.substring(t, 7, 2).try_cast("int"),
    )


def parse_yyyymmddhhmm(text) -> Column:
    t = _c(text).cast("string")
    seconds = F.substring(t, 9, 2).try_cast("int") * 3600 + F.substring(t, 11, 2).try_cast("int") * 60
    return plus_seconds(parse_yyyymmdd(F.substring(t, 1, 8)).cast("timestamp_ntz"), seconds)


def parse_mcdate(mcdate, mcsec) -> Column:
    """Model date number (zero padded ``YYYYMMDD``) and seconds of day."""
    return plus_seconds(parse_yyyymmdd(mcdate).cast("timestamp_ntz"), _c(mcsec))


def floor_halfhour(hour) -> Column:
    return F.floor(_c(hour) * 2) / 2.0


def bin_time(ts, width: int = 1800, label: str = "start") -> Column:
    """Edge of the ``width``-second bin holding ``ts``; bins count from 1970.

    ``end`` labels follow interval-end files: a time exactly on an edge opens
    the next interval, as with start labels, and gets that interval's end.
    Rows without a time have no bin and are left out.
    """
    return F.window(_c(ts), f"{width} seconds")[label]


def shift_zone(ts, from_offset: str = "+00:00", to_offset: str = "-07:00") -> Column:
    """Fixed-offset clock change (no daylight saving)."""
    return F.convert_timezone(F.lit(from_offset), F.lit(to_offset), _c(ts))


def season(month) -> Column:
    """DJF / MAM / JJA / SON; NULL month has no season."""
    m = _c(month)
    return (
        F.when(m.isin(12, 1, 2), "DJF")
        .when(m.isin(3, 4, 5), "MAM")
        .when(m.isin(6, 7, 8), "JJA")
        .when(m.isin(9, 10, 11), "SON")
    )


def is_leap_day(date) -> Column:
    d = _c(date)
    return (F.month(d) == 2) & (F.day(d) == 29)


def noleap_doy(date) -> Column:
    """Day of year 1 … 365 with 29 February left out (NULL on that day)."""
    d = _c(date)
    doy = F.dayofyear(d)
    return F.when(
        ~is_leap_day(d), doy - F.when(is_leap_year(F.year(d)) & (doy > 59), 1).otherwise(0)
    )


def hourmin(ts) -> Column:
    """Hour to one decimal; halves go to the even digit (10.25 → 10.2)."""
    t = _c(ts)
    return F.rint((F.hour(t) + F.minute(t) / 60.0) * 10) / 10


def monday_key(ts) -> Column:
    t = _c(ts)
    return F.round(F.month(t) + F.day(t) / 100.0, 2)


def year_mon(ts) -> Column:
    t = _c(ts)
    return F.format_string("%04d-%02d", F.year(t), F.month(t))


def year_plus_frac(ts) -> Column:
    """Year plus elapsed fraction of a 365-day year."""
    t = _c(ts)
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return F.year(t) + (noleap_doy(F.to_date(t)) - 1 + seconds / float(DAY_SECONDS)) / 365.0


def time_mid(lo, hi) -> Column:
    """Middle of two bounds, to the microsecond."""
    a = epoch_micros(lo)
    return ts_from_micros(a + F.floor((epoch_micros(hi) - a) / 2))


def noleap_to_ts(year, doy, seconds) -> Column:
    """Civil timestamp of a 365-day-calendar stamp; 29 February is stepped over."""
    skip = F.when(is_leap_year(year) & (_c(doy) > 59), 1).otherwise(0)
    first = F.make_date(_c(year), F.lit(1), F.lit(1))
    day = F.date_add(first, (_c(doy) - 1 + skip).cast("int")).cast("timestamp_ntz")
    return plus_seconds(day, _c(seconds))


def dummy_date(doy) -> Column:
    """Plotting date in 2000; one day late on purpose, as published figures use it."""
    return F.date_add(F.lit("2000-01-01").cast("date"), _c(doy).cast("int"))


def year_span(first, last) -> Column:
    """``2008 | 2009 | 2010`` for the years of a span."""
    years = F.sequence(_c(first).cast("int"), _c(last).cast("int"))
    return F.array_join(F.transform(years, lambda y: y.cast("string")), " | ")


def quarter_from_december(date) -> Column:
    """First day of the quarter when quarters start in December."""
    d = F.to_date(_c(date))
    back = F.month(d) % 3
    return F.add_months(F.make_date(F.year(d), F.month(d), F.lit(1)), -back)


def days_in_month(month) -> Column:
    """Days per month of a 365-day year."""
    lengths = [31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    return F.element_at(F.array(*[F.lit(n) for n in lengths]), _c(month).cast("int"))

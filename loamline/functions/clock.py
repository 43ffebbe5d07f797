"""Time expressions. Times are without zone, in UTC, so no session setting changes them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RAW = r"^([0-9]{4})([0-9]{2})([0-9]{8})([SD]?)\z"


def raw_digits(t: Column) -> Column:
    """Fourteen digits with the month counted from 1; null unless the text is a raw time."""
    month = F.lpad((F.regexp_extract(t, RAW, 2).cast("int") + 1).cast("string"), 2, "0")
    return F.when(t.rlike(RAW), F.concat(F.regexp_extract(t, RAW, 1), month, F.regexp_extract(t, RAW, 3)))


def daylight(t: Column) -> Column:
    return F.coalesce(F.right(t, F.lit(1)) == "D", F.lit(False))


def moment(digits: Column) -> Column:
    """Fourteen digits as a time; null for a day or hour that doesn't exist."""
    part = lambda at, n: F.substring(digits, at, n)
    text = F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit(" "), part(9, 2), F.lit(":"), part(11, 2), F.lit(":"), part(13, 2))
    return text.try_cast("timestamp_ntz")


def less_seconds(t: Column, seconds: Column) -> Column:
    return t - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def raw_moment(t: Column) -> Column:
    """A raw time as a time, its month counted from 0; null for another text, or a day or hour that doesn't exist."""
    part = lambda at, n: F.substring(t, at, n).try_cast("int")
    made = F.try_make_timestamp_ntz(part(1, 4), part(5, 2) + 1, part(7, 2), part(9, 2), part(11, 2), part(13, 2))
    return F.when(t.rlike(RAW) & (part(13, 2) < 60), made)


def to_utc(raw: Column, epoch: Column, standard: Column, summer: Column) -> Column:
    """Raw time to UTC: the server's offset (seconds) counts up to its epoch; later, or without epoch or zone, times are UTC already."""
    return shifted(raw_moment(raw), raw, epoch, standard, summer)


def shifted(t: Column, raw: Column, epoch: Column, standard: Column, summer: Column) -> Column:
    """The same for a raw time that is read already."""
    offset = F.when(daylight(raw), summer).otherwise(standard)
    local = epoch.isNotNull() & standard.isNotNull() & (t <= epoch)
    return F.when(F.coalesce(local, F.lit(False)), less_seconds(t, F.coalesce(offset, standard))).otherwise(t)


def zone_offset(zone: Column) -> Column:
    """Seconds of `-0500`, `+01:00` or `Z`; null for another text."""
    form = r"^([+-])([0-9]{2}):?([0-9]{2})\z"
    size = F.regexp_extract(zone, form, 2).cast("int") * 3600 + F.regexp_extract(zone, form, 3).cast("int") * 60
    return F.when(F.upper(zone) == "Z", F.lit(0)).when(zone.rlike(form), F.when(F.regexp_extract(zone, form, 1) == "-", -size).otherwise(size))


def epoch_moment(text: Column) -> Column:
    """`200808070330`, with or without a zone behind, as a UTC time; null if malformed."""
    form = r"^([0-9]{12})(Z|z|[+-][0-9]{2}:?[0-9]{2})?\z"
    t = moment(F.when(text.rlike(form), F.concat(F.regexp_extract(text, form, 1), F.lit("00"))))
    return less_seconds(t, F.coalesce(zone_offset(F.regexp_extract(text, form, 2)), F.lit(0)))


def shown(t: Column) -> Column:
    """YYYY-MM-DD HH:MM:SS."""
    return t.cast("string")

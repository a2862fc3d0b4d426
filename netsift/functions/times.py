"""Time expressions.

Instants are ``timestamp_ntz`` values that hold UTC, so nothing here depends on
the session time zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"
_TRANSFER_DATE = (
    r"\A(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})"
    r"(?:(?:\.\d{1,6})?(Z|[+-]\d{2}:?\d{2}(?::?\d{2}(?:\.\d{1,6})?)?))?\z"
)
_US_DATE = r"\A(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\z"
_ISO_DATE = r"\A(\d{4})-(\d{1,2})-(\d{1,2})\z"
_OFFSET = r"(Z|[+-]\d{2}:?\d{2})\z"


def from_epoch(seconds: Column) -> Column:
    """Whole seconds since 1970 -> UTC instant."""
    secs = seconds.try_cast("bigint").try_cast("decimal(18,6)")
    return F.expr(_EPOCH) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)


def iso(ntz: Column) -> Column:
    """UTC instant -> ``2024-01-14T18:04:28Z``."""
    return F.concat(F.replace(F.substring(ntz.cast("string"), 1, 19), F.lit(" "), F.lit("T")), F.lit("Z"))


def now_utc() -> Column:
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz"))


def as_instant(value) -> Column:
    """``seen`` argument: None (now), ISO text, or a column."""
    if value is None:
        return now_utc()
    if isinstance(value, Column):
        return value
    return F.lit(str(value).rstrip("Z").replace("T", " ")).cast("timestamp_ntz")


def _part(c: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(c, pattern, group).try_cast("int")


def _build(c: Column, pattern: str, order: tuple[int, ...]) -> Column:
    """Instant from the groups of ``pattern``; null when it does not match or is no real date."""
    parts = [_part(c, pattern, g) for g in order]
    parts += [F.lit(0)] * (6 - len(parts))
    year, month, day, hour, minute, second = parts
    made = F.try_make_timestamp_ntz(year, month, day, hour, minute, second.cast("decimal(16,6)"))
    return F.when(c.rlike(pattern) & (year > 0) & (second < 60), made)


def compact_date(c: Column) -> Column:
    """``20070502`` -> midnight UTC; anything else is null."""
    return _build(c, r"\A(\d{4})(\d{2})(\d{2})\z", (1, 2, 3))


def _offset_seconds(zone: Column) -> Column:
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    hours = F.regexp_extract(zone, r"[+-](\d{2})", 1).try_cast("int")
    minutes = F.regexp_extract(zone, r"[+-]\d{2}:?(\d{2})", 1).try_cast("int")
    seconds = F.coalesce(F.regexp_extract(zone, r"[+-]\d{2}:?\d{2}:?(\d{2})", 1).try_cast("int"), F.lit(0))
    return F.coalesce(sign * (hours * 3600 + minutes * 60 + seconds), F.lit(0))


def _shift(ntz: Column, seconds: Column) -> Column:
    return ntz - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def transfer_date(c: Column, utc: bool = False) -> Column:
    """Normalise the three registry date forms to ISO text; other text is unchanged.

    The offset is dropped (wall clock) unless ``utc`` asks for conversion.
    """
    wall = _build(c, _TRANSFER_DATE, (1, 2, 3, 4, 5, 6))
    if utc:
        wall = _shift(wall, _offset_seconds(F.regexp_extract(c, _TRANSFER_DATE, 7)))
    return F.coalesce(iso(wall), c)


def licence_date(c: Column) -> Column:
    """``01/02/2020 00:00:00`` or ``2020-01-02``; anything else is null."""
    return F.coalesce(_build(F.trim(c), _US_DATE, (3, 1, 2, 4, 5, 6)), _build(c, _ISO_DATE, (1, 2, 3)))


def probe_time(c: Column, utc: bool = False) -> Column:
    """Web-probe time: cut fraction and offset, end with Z; ``utc`` applies the offset first."""
    wall = F.regexp_replace(F.split_part(c, F.lit("."), F.lit(1)), _OFFSET, "")
    if not utc:
        return F.concat(wall, F.lit("Z"))
    return iso(_shift(wall.try_cast("timestamp_ntz"), _offset_seconds(F.regexp_extract(c, _OFFSET, 1))))

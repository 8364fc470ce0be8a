"""Text to typed value, where a bad value becomes NULL whatever the session's ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bytes that a numeric cast ignores at both ends: ASCII control characters and the space.
_PAD = r"[\x00-\x20\x7f]*"
_ONLY_FRACTION = rf"^{_PAD}[+-]?[.][0-9]*{_PAD}$"
_FRACTION = rf"(?<=[0-9])[.][0-9]*{_PAD}$"

# A clock time without a date, with optional seconds, fraction and zone.
_TIME_ONLY = r"^\s*T?[0-9]{1,2}:[0-9]{1,2}(:.*)?$"

TIME_FORMAT = "HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c: Column | str) -> Column:
    """Text to int; a decimal fraction is cut off ('12.5' is 12, '.5' is 0), bad text is NULL.

    Clean integers are settled by the plain ``try_cast``; only text it refuses meets a pattern.
    """
    text = _col(c)
    cut = F.when(text.rlike(_ONLY_FRACTION), F.lit(0)).when(
        text.contains("."), F.regexp_replace(text, _FRACTION, "").try_cast("int")
    )
    return F.coalesce(text.try_cast("int"), cut)


def seconds_of_day(time: Column) -> Column:
    """Seconds since midnight of a timestamp."""
    return F.hour(time) * 3600 + F.minute(time) * 60 + F.second(time)


def clock_time(c: Column | str) -> Column:
    """Text ``HH:mm:ss`` to a timestamp on the epoch day; NULL if it is not such a time."""
    return F.try_to_timestamp(_col(c), F.lit(TIME_FORMAT))


def arrival_timestamp(c: Column | str, day: Column | str) -> Column:
    """Text to timestamp. A time without a date belongs to ``day``, never to the day of the run."""
    text, day_text = _col(c), _col(day).try_cast("date").cast("string")
    anchored = F.concat(day_text, F.lit(" "), F.ltrim(F.regexp_replace(text, r"^\s*T", "")))
    return F.when(text.rlike(_TIME_ONLY), anchored).otherwise(text).try_cast("timestamp")


def typed(c: Column | str, dtype: str) -> Column:
    """Text to ``dtype``: NULL for bad values, fractions cut for ``int``."""
    return lenient_int(c) if dtype == "int" else _col(c).try_cast(dtype)

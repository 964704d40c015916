"""Row identity and flag texts of the unified observation table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separators, and what stands for a missing part of the identity.
ID_SEPARATOR = "||"
NO_ADMISSION = "NO_HADM"
NO_ITEM = "NO_ITEM"
NO_TIME = "NO_TIME"
FLAG_SEPARATOR = "|"


def utc_text(time: Column) -> Column:
    """A point in time as ``yyyy-MM-dd HH:mm:ss``, with a fraction if it has one, in UTC."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    since = F.expr("interval '0.000001' second") * F.unix_micros(time.cast("timestamp"))
    return (epoch + since).cast("string")


def _untimed(source: Column, row: Column, subject: Column, admission: Column, item: Column) -> Column:
    known = (source, row, subject, F.coalesce(admission, F.lit(NO_ADMISSION)), F.coalesce(item, F.lit(NO_ITEM)))
    return F.concat_ws(ID_SEPARATOR, *known)


def observation_id(
    source: Column, row: Column, subject: Column, admission: Column, item: Column, time: Column
) -> Column:
    """SHA-256 of the parts that identify an observation.

    A NULL ``source``, ``row`` or ``subject`` is left out of the text, as ``concat_ws`` does.
    The time enters as its UTC text, whatever the time zone of the session.
    """
    untimed = _untimed(source, row, subject, admission, item)
    return F.sha2(F.concat_ws(ID_SEPARATOR, untimed, F.coalesce(utc_text(time), F.lit(NO_TIME))), 256)


def observation_parts(
    source: Column, row: Column, subject: Column, admission: Column, item: Column, time: Column
) -> list[Column]:
    """What is equal for equal observation ids and cheaper to make: the text before the time, and the time.

    No time has the separator in its text, so equal texts agree on both.
    """
    return [_untimed(source, row, subject, admission, item), F.unix_micros(time.cast("timestamp"))]


def event_flag(**flags: Column) -> Column:
    """``name=value`` of every flag, NULL as empty, joined by a bar."""
    named = [F.concat(F.lit(f"{name}="), F.coalesce(c, F.lit(""))) for name, c in flags.items()]
    return F.concat_ws(FLAG_SEPARATOR, *named)

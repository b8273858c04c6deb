"""Time expressions that never read the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NTZ_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def utc_day(ts: Column) -> Column:
    """UTC calendar day of an instant."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts) / 86400).cast("int"))


def utc_hour(ts: Column) -> Column:
    """UTC hour of day (0-23) of an instant."""
    return F.pmod(F.floor(F.unix_seconds(ts) / 3600), F.lit(24)).cast("int")


def utc_wall_clock(ts: Column) -> Column:
    """Instant to TIMESTAMP_NTZ holding its UTC wall clock, for zone-free display."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), F.expr(_NTZ_EPOCH))


def instant_from_utc(ntz: Column) -> Column:
    """TIMESTAMP_NTZ read as a UTC wall clock, to an instant."""
    whole_days = F.unix_date(ntz.cast("date")).cast("long") * 86400
    in_day = F.hour(ntz) * 3600 + F.minute(ntz) * 60 + F.second(ntz)
    micros = F.pmod(F.extract(F.lit("SECOND"), ntz) * 1000000, F.lit(1000000)).cast("long")
    return F.timestamp_micros((whole_days + in_day) * 1000000 + micros)


_LOCAL_DATE_TIME = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?)?$"


def parse_instant(text: Column) -> Column:
    """Text to instant, NULL when it does not parse.

    A date-time without an offset is read in UTC, so the host zone cannot move
    it. Spark also accepts a bare time of day (as today) and a bare year; both
    are kept as Spark reads them. A text ending in ``+hh:mm`` or ``-hh:mm``, the
    contract's own form, skips the pattern check.
    """
    zoned = (F.length(text) > 16) & F.substring(text, -6, 1).isin("+", "-")
    bare = F.trim(text)
    as_utc = F.concat(
        bare, F.when(F.length(bare) > 10, "+00:00").otherwise("T00:00:00+00:00")
    )
    local = ~zoned & bare.rlike(_LOCAL_DATE_TIME)
    return F.try_to_timestamp(F.when(local, as_utc).otherwise(text))

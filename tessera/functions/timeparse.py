"""Timestamps in file names and in mixed units, as Column -> Column functions. Epochs are long microseconds or double seconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STAMP = r"\d{8}_\d{6}_\d{6}"
FORMAT = "yyyyMMdd_HHmmss_SSSSSS"
#: File times before 2010 are taken for wrong clocks.
PLAUSIBLE_S = 1262304000.0


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zoneless timestamp (read as UTC), whatever the session's zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def from_micros(us: Column) -> Column:
    """The zoneless timestamp (UTC) of microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def stamp(name: Column) -> Column:
    """The first stamp in a file name as a zoneless timestamp; null if none parses."""
    text = F.nullif(F.regexp_extract(name, STAMP, 0), F.lit(""))
    p = r"(\d{4})(\d{2})(\d{2})_(\d{2})(\d{2})(\d{2})_(\d{6})"
    return F.regexp_replace(text, p, "$1-$2-$3 $4:$5:$6.$7").try_cast("timestamp_ntz")


def name_to_epoch(name: Column, zone: str | None = None) -> Column:
    """Epoch seconds of a file name; stamps are local to zone, or UTC without one."""
    local = stamp(name)
    return micros(F.convert_timezone(F.lit(zone), F.lit("UTC"), local) if zone else local) / F.lit(1e6)


def strict_epoch(text: Column, zone: str | None = None) -> Column:
    """Epoch seconds of a text that is a stamp and nothing else; any other text is an error, null stays null."""
    wrong = F.raise_error(F.concat(F.lit("not a stamp: "), text)).cast("double")
    return F.when(text.isNull(), F.lit(None)).when(text.rlike(f"^(?:{STAMP})$") & stamp(text).isNotNull(), name_to_epoch(text, zone)).otherwise(wrong)


def plausible(seconds: Column) -> Column:
    return seconds.isNotNull() & ~F.isnan(seconds) & (seconds >= PLAUSIBLE_S) & (seconds < float("inf"))


def compact_key(name: Column) -> Column:
    """A stamp as a 20-digit number (too long for a long)."""
    return F.replace(F.nullif(F.regexp_extract(name, STAMP, 0), F.lit("")), F.lit("_"), F.lit("")).cast("decimal(20,0)")


def epoch_to_micros(t: Column) -> Column:
    """An integer epoch of unknown unit: over 1e17 ns, over 1e14 us, over 1e11 ms, else s; 0 and below: null."""
    t = t.cast("long")
    ladder = F.when(t <= 0, F.lit(None).cast("long"))
    ladder = ladder.when(t > 10**17, F.floor(t.cast("decimal(20,0)") / 1000).cast("long"))  # a double would round
    return ladder.when(t > 10**14, t).when(t > 10**11, t * 1000).otherwise(t * 1_000_000).cast("long")


def any_to_micros(text: Column) -> Column:
    """A stamp, or the first number in a string as an epoch of unknown unit (with a fraction: seconds)."""
    number = F.nullif(F.regexp_extract(text, r"\d+(?:\.\d+)?", 0), F.lit(""))
    whole = epoch_to_micros(F.when(~number.contains("."), number).try_cast("long"))
    return F.coalesce(micros(stamp(text)), F.when(number.contains("."), F.rint(number.try_cast("double") * 1e6).cast("long")), whole)


def normalised(text: Column, zone: str | None = None) -> Column:
    """Microseconds since 1970 of a number of seconds, a stamp, or an ISO date and time (both local to zone, or UTC); null for others."""
    local = F.coalesce(F.when(text.rlike(f"^(?:{STAMP})$"), stamp(text)), F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}([ T]|$)"), text).try_cast("timestamp_ntz"))
    number = F.when(text.rlike(r"^\s*-?\d+(\.\d+)?([eE][+-]?\d+)?\s*$"), text).try_cast("double")
    return F.coalesce(F.rint(number * 1e6).cast("long"), micros(F.convert_timezone(F.lit(zone), F.lit("UTC"), local) if zone else local))


def strict_micros(text: Column, zone: str | None = None) -> Column:
    """As normalised, but a text that is none of these is an error that shows it; null stays null."""
    us = normalised(text, zone)
    return F.when(text.isNull() | us.isNotNull(), us).otherwise(F.raise_error(F.concat(F.lit("not a time: "), text)).cast("long"))


def format_stamp(us: Column, zone: str | None = None) -> Column:
    """Microseconds since 1970 as a file name stamp, in zone or UTC."""
    ts = from_micros(us)
    return F.date_format(F.convert_timezone(F.lit("UTC"), F.lit(zone), ts) if zone else ts, FORMAT)


def midpoint(t0: Column, t1: Column) -> Column:
    return 0.5 * (t0 + t1)

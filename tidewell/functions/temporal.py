"""Datetimes, durations and cursor values."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# The datetime patterns that are accepted, in order of trial.
DATETIME_PATTERNS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSSSSS]XXX",
    "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]XXX",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd",
    "yyyy/MM/dd",
)

# Strftime codes and the matching Java letters.
STRFTIME_CODES = {
    "%Y": "yyyy",
    "%m": "MM",
    "%d": "dd",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
    "%j": "DDD",
    "%y": "yy",
    "%6f": "SSSSSS",
    "%3f": "SSS",
    "%.6f": ".SSSSSS",
    "%.3f": ".SSS",
    "%F": "yyyy-MM-dd",
    "%T": "HH:mm:ss",
}

# Duration suffixes, in seconds.
SUFFIX_SECONDS = {"w": 604800, "d": 86400, "h": 3600, "m": 60, "s": 1}


@dataclass(frozen=True)
class Duration:
    """A step of calendar months plus exact seconds."""

    months: int = 0
    seconds: int = 0

    def sql(self) -> str:
        if self.months and self.seconds:
            raise ValueError("a step mixes months and seconds")
        if self.months:
            return f"INTERVAL '{self.months}' MONTH"
        return f"INTERVAL '{self.seconds}' SECOND"


def parse_duration(text: str) -> Duration:
    """``7d``, ``12h``, ``30m``, ``45s``, ``2w``, a bare number of days, or ISO-8601 (``P1M``, ``PT6H``)."""
    text = text.strip()
    if text.startswith("P"):
        iso = re.fullmatch(
            r"P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+)S)?)?", text
        )
        if not iso or not any(iso.groups()):
            raise ValueError(f"invalid duration: {text}")
        years, months, weeks, days, hours, minutes, seconds = (int(g or 0) for g in iso.groups())
        return Duration(
            years * 12 + months, weeks * 604800 + days * 86400 + hours * 3600 + minutes * 60 + seconds
        )
    plain = re.fullmatch(r"([+-]?\d+)([wdhms]?)", text)
    if not plain:
        raise ValueError(f"invalid duration: {text}")
    return Duration(seconds=int(plain[1]) * SUFFIX_SECONDS[plain[2] or "d"])


def java_pattern(strftime: str) -> str:
    """A strftime pattern as a Spark datetime pattern."""
    out, literal = "", ""

    def flush() -> str:
        if not literal:
            return ""
        return "'" + literal.replace("'", "''") + "'" if re.search("[A-Za-z']", literal) else literal

    i = 0
    while i < len(strftime):
        if strftime[i] == "%":
            code = re.match(r"%\.?\d?[A-Za-z]", strftime[i:])
            if not code or code[0] not in STRFTIME_CODES:
                raise ValueError(f"unsupported strftime code in {strftime!r}")
            out += flush() + STRFTIME_CODES[code[0]]
            literal = ""
            i += len(code[0])
        else:
            literal += strftime[i]
            i += 1
    return out + flush()


def parse_datetime(text: Column) -> Column:
    """Text as a UTC timestamp without zone; NULL when no known pattern fits."""
    tries = []
    for pattern in DATETIME_PATTERNS:
        # Parsing and dropping the zone both use the session zone, so it cancels out.
        local = F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")
        if pattern.endswith("XXX"):
            local = F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)
        tries.append(local)
    return F.coalesce(*tries)


def epoch_micros(moment: Column) -> Column:
    """Microseconds since 1970 of a timestamp without zone, read as UTC."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), moment)


def cursor_text(cursor: Column, dtype: str) -> Column:
    """A cursor value as the text kept in state, for a column of Spark type ``dtype``; always in UTC."""
    if dtype == "timestamp":
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        cursor = F.timestamp_add("MICROSECOND", F.unix_micros(cursor), epoch)
    if dtype in ("timestamp", "timestamp_ntz"):
        return F.date_format(cursor, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    if dtype == "date":
        return F.date_format(cursor, "yyyy-MM-dd")
    return cursor.cast("string")


def normalise_cursor(value: Column, fmt: str) -> Column:
    """A cursor in one of the formats iso8601, unix, unix_ms or string as a comparable value."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    if fmt == "iso8601":
        return parse_datetime(value)
    if fmt == "unix":
        return F.timestamp_add("SECOND", value.cast("bigint"), epoch)
    if fmt == "unix_ms":
        return F.timestamp_add("MILLISECOND", value.cast("bigint"), epoch)
    if fmt == "string":
        return value.cast("string")
    raise ValueError(f"unknown cursor format: {fmt}")

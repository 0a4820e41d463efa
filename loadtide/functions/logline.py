"""Access-log line expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Line and request patterns, timestamp format and the fill-in for
# requests that cannot be read.
LOG_PATTERN = (
    r'^(?P<host>\S+)\s+\S+\s+\S+\s+\[(?P<ts>[^\]]+)\]\s+'
    r'"(?P<request>[^"]*)"\s+(?P<status>\d{3})\s+(?P<bytes>\S+)\s*$'
)
REQUEST_PATTERN = r"^(?P<method>[A-Z]+)\s+(?P<url>\S+)\s+(?P<version>HTTP/\d\.\d)$"
TS_FORMAT = "d/MMM/yyyy:H:m:s Z"
UNREADABLE = "UNKNOWN"

LINE_FIELDS = ("host", "ts", "request", "status", "bytes")
REQUEST_FIELDS = ("method", "url", "version")
SEPARATOR = "\x01"


@dataclass(frozen=True)
class LineFormat:
    """Patterns may use either spelling of named groups; ``ts_format`` is a Spark pattern."""

    log_pattern: str = LOG_PATTERN
    request_pattern: str = REQUEST_PATTERN
    ts_format: str = TS_FORMAT


def group_numbers(pattern: str, names: tuple[str, ...]) -> list[int]:
    index = re.compile(re.sub(r"\(\?<(?![=!])", "(?P<", pattern)).groupindex
    missing = [n for n in names if n not in index]
    if missing:
        raise ValueError(f"pattern lacks the groups {missing}")
    return [index[n] for n in names]


def captures(text: Column, pattern: str, names: tuple[str, ...]) -> Column:
    """The named groups behind an empty first element; one element where nothing matches.

    The pattern has to match from the start. If it is anchored at both ends, one replace
    joins all groups with a separator and one split takes them apart, so it runs once per
    line instead of once per group. Text that already holds the separator, and open-ended
    patterns, go group by group.
    """
    numbers = group_numbers(pattern, names)
    regex = pattern.replace("(?P<", "(?<")
    if not regex.startswith("^"):
        regex = f"^(?:{regex})"
    groups = F.array(F.lit(""), *[F.regexp_extract(text, regex, n) for n in numbers])
    one_by_one = F.when(text.rlike(regex), groups).otherwise(F.array(F.lit("")))
    if not (pattern.startswith("^") and pattern.endswith("$")):
        return one_by_one
    joined = F.regexp_replace(text, regex, SEPARATOR + SEPARATOR.join(f"${n}" for n in numbers))
    return F.when(F.contains(text, F.lit(SEPARATOR)), one_by_one).otherwise(F.split(joined, SEPARATOR))


def matched(parts: Column, names: tuple[str, ...]) -> Column:
    return F.size(parts) == len(names) + 1


def instant(text: Column, ts_format: str = TS_FORMAT) -> Column:
    """Instant of a timestamp with an offset; NULL when it cannot be read."""
    return F.try_to_timestamp(text, F.lit(ts_format))


def byte_count(text: Column) -> Column:
    """Whole number of bytes, NULL for ``-``, blanks and fractions."""
    whole = text.rlike(r"^[+-]?\d+(_\d+)*$")
    return F.when(whole, F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"))

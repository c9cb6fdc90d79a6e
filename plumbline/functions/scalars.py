"""Small Column builders shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(col: Column, data_type: T.DataType, fmt: str = TIMESTAMP_FORMAT) -> Column:
    """Text becomes a timestamp in a fixed format (null if it does not parse); time types pass through."""
    if isinstance(data_type, T.StringType):
        return F.try_to_timestamp(col, F.lit(fmt))
    return col


def minutes_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(60_000_000.0)


def slug(col: Column) -> Column:
    return F.regexp_replace(col, " ", "_")


def split_list(col: Column) -> Column:
    """A comma list as an array of trimmed names without empty entries."""
    return F.filter(F.transform(F.split(col, ","), lambda name: F.trim(name)), lambda name: name != "")


def canonical_json(col: Column) -> Column:
    """JSON text with sorted keys and no spaces; null where the text is not JSON."""
    return F.to_json(F.try_parse_json(col))


def percent(part: Column, whole: Column) -> Column:
    """`100 * part / whole`, null when there is nothing to divide by."""
    return F.when(whole > 0, F.lit(100.0) * part / whole)

"""Checks by name.

A row check maps a column to a predicate that good values satisfy. Null values never reach the
predicate: the evaluation counts them as missing. New row checks are added with the decorator:

    @expectation("expect_column_values_to_be_even")
    def even(value, data_type, kwargs):
        return value % 2 == 0
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from decimal import Decimal, InvalidOperation
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

RowCheck = Callable[[Column, T.DataType, Mapping[str, Any]], Column]

# Checks that are not row predicates. The evaluation knows how to plan each of them.
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
OF_TYPE = "expect_column_values_to_be_of_type"
UNIQUE = "expect_column_values_to_be_unique"
IN_SET = "expect_column_values_to_be_in_set"
MATCHES = "expect_column_values_to_match_regex"

PLANNED_CHECKS = (ROW_COUNT, COLUMN_EXISTS, NOT_NULL, OF_TYPE, UNIQUE)

_ROW_CHECKS: dict[str, RowCheck] = {}


def expectation(name: str) -> Callable[[RowCheck], RowCheck]:
    """Register a row check under a rule name."""

    def add(fn: RowCheck) -> RowCheck:
        _ROW_CHECKS[name] = fn
        return fn

    return add


def row_check(name: str | None) -> RowCheck | None:
    return _ROW_CHECKS.get(name or "")


def registered() -> list[str]:
    return sorted((*_ROW_CHECKS, *PLANNED_CHECKS))


def literal(value: Any, data_type: T.DataType) -> Column:
    """A rule parameter as a literal that compares with the column without casting the column.

    Parameters are parsed here, on the driver, so that a bad one fails its own rule and never the job.
    """
    if isinstance(data_type, (T.IntegralType, T.DecimalType)):
        try:
            number = Decimal(str(value))
        except InvalidOperation as error:
            raise ValueError(f"{value!r} is not a number") from error
        if isinstance(data_type, T.IntegralType) and number == number.to_integral_value():
            whole = int(number)
            return F.lit(whole) if abs(whole) < 2**63 else F.lit(float(whole))
        return F.lit(number) if isinstance(data_type, T.DecimalType) else F.lit(float(number))
    if isinstance(data_type, T.FractionalType):
        return F.lit(float(value)).cast(data_type)
    if isinstance(data_type, T.BooleanType):
        if isinstance(value, bool):
            return F.lit(value)
        if str(value).lower() in ("true", "false"):
            return F.lit(str(value).lower() == "true")
        raise ValueError(f"{value!r} is not a truth value")
    if isinstance(data_type, T.DateType):
        # A day, or a moment: Spark compares a date with a moment as the moment the day begins.
        moment = dt.datetime.fromisoformat(str(value))
        if moment.tzinfo is None and moment.time() == dt.time():
            return F.lit(moment.date())
        return F.lit(moment.isoformat(sep=" ")).cast("timestamp" if moment.tzinfo else "timestamp_ntz")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        moment = dt.datetime.fromisoformat(str(value))
        return F.lit(moment.isoformat(sep=" ")).cast(data_type)
    return F.lit(str(value))


def bounds(kwargs: Mapping[str, Any]) -> tuple[str | None, str | None]:
    """The bounds of a row-count rule as decimal text; a missing bound is open."""
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    if low is None and high is None:
        raise ValueError("min_value or max_value is required")
    try:
        return tuple(None if b is None else f"{Decimal(str(b)):f}" for b in (low, high))
    except InvalidOperation as error:
        raise ValueError(f"{low!r}, {high!r} are not both numbers") from error


def within(value: Column, data_type: T.DataType, kwargs: Mapping[str, Any]) -> Column:
    """An inclusive range; a missing bound is open."""
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    if low is None and high is None:
        raise ValueError("min_value or max_value is required")
    parts = []
    if low is not None:
        parts.append(value >= literal(low, data_type))
    if high is not None:
        parts.append(value <= literal(high, data_type))
    return parts[0] if len(parts) == 1 else parts[0] & parts[1]


@expectation(IN_SET)
def _in_set(value: Column, data_type: T.DataType, kwargs: Mapping[str, Any]) -> Column:
    # A null member would turn every non-member into null, and so hide it. Sets that are tables (`value_table`) never
    # get here: the evaluation joins them.
    members = [literal(v, data_type) for v in kwargs["value_set"] if v is not None]
    return value.isin(*members) if members else F.lit(False)


@expectation("expect_column_values_to_be_between")
def _between(value: Column, data_type: T.DataType, kwargs: Mapping[str, Any]) -> Column:
    return within(value, data_type, kwargs)


@expectation(MATCHES)
def _matches(value: Column, data_type: T.DataType, kwargs: Mapping[str, Any]) -> Column:
    return value.cast("string").rlike(kwargs["regex"])


@expectation("expect_column_value_lengths_to_be_between")
def _length_between(value: Column, data_type: T.DataType, kwargs: Mapping[str, Any]) -> Column:
    return within(F.length(value.cast("string")), T.IntegerType(), kwargs)


@expectation("expect_column_values_to_be_greater_than")
def _greater_than(value: Column, data_type: T.DataType, kwargs: Mapping[str, Any]) -> Column:
    return value > literal(kwargs["value"], data_type)


# Checks whose predicate the engine builds from values it has parsed, so that no row can make them fail.
_CANNOT_FAIL = frozenset(_ROW_CHECKS)


def may_fail(name: str | None) -> bool:
    """Whether a check may raise an error on some row: one that a user registered."""
    return name in _ROW_CHECKS and name not in _CANNOT_FAIL


def is_of_type(data_type: T.DataType, alias: str) -> bool:
    """Whether a column type answers to a type name used in rules.

    Fixed values: the SQL and logical type names that rules use.
    TEXT, CHAR, string: text. INTEGER: any integral type. NUMERIC, number: any numeric type.
    TIMESTAMP: with or without zone. datetime: those and date. Anything else is a Spark type name.
    """
    name = alias.strip().lower()
    if name in ("text", "char", "string"):
        return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))
    if name == "integer":
        return isinstance(data_type, T.IntegralType)
    if name in ("numeric", "number"):
        return isinstance(data_type, T.NumericType)
    if name == "timestamp":
        return isinstance(data_type, (T.TimestampType, T.TimestampNTZType))
    if name == "datetime":
        return isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType))
    return data_type.simpleString().lower() == name

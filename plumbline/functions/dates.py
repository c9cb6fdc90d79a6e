"""Date macros over an anchor date.

Each builder takes the anchor as a date Column and returns a date Column. `render` turns the
result into text. `register_date_macros` makes the same macros callable from rule conditions,
anchored at a fixed day, so that a run gives the same answer when it is repeated.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

ISO_DATE = "%Y-%m-%d"

# Strftime directives and the date patterns that mean the same.
_PATTERNS = {
    "%Y": "yyyy",
    "%y": "yy",
    "%m": "MM",
    "%b": "MMM",
    "%B": "MMMM",
    "%d": "dd",
    "%j": "DDD",
    "%a": "EEE",
    "%A": "EEEE",
    "%H": "HH",
    "%M": "mm",
    "%S": "ss",
}


def today(anchor: Column) -> Column:
    return anchor


def today_plus(anchor: Column, days: int = 0) -> Column:
    return F.date_add(anchor, days)


def today_minus(anchor: Column, days: int = 0) -> Column:
    return F.date_sub(anchor, days)


def month_start(anchor: Column) -> Column:
    return F.trunc(anchor, "MM")


def month_end(anchor: Column) -> Column:
    return F.last_day(anchor)


def month_plus(anchor: Column, months: int = 1) -> Column:
    return F.add_months(anchor, months)


def month_minus(anchor: Column, months: int = 1) -> Column:
    return F.add_months(anchor, -months)


def quarter_start(anchor: Column) -> Column:
    return F.trunc(anchor, "QUARTER")


def quarter_end(anchor: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(anchor, "QUARTER"), 2))


def quarter_plus(anchor: Column, quarters: int = 1) -> Column:
    return F.add_months(anchor, 3 * quarters)


def quarter_minus(anchor: Column, quarters: int = 1) -> Column:
    return F.add_months(anchor, -3 * quarters)


def year_start(anchor: Column) -> Column:
    return F.trunc(anchor, "YEAR")


def year_end(anchor: Column) -> Column:
    return F.make_date(F.year(anchor), F.lit(12), F.lit(31))


def year_plus(anchor: Column, years: int = 1) -> Column:
    return F.add_months(anchor, 12 * years)


def year_minus(anchor: Column, years: int = 1) -> Column:
    return F.add_months(anchor, -12 * years)


def date_pattern(fmt: str) -> str:
    """The date pattern of a strftime format. Text between directives is quoted, so it stays as it is."""
    pattern, plain = "", ""
    for part in re.split(r"(%.)", fmt):
        if part == "%%":
            plain += "%"
        elif not part.startswith("%"):
            plain += part
        elif part in _PATTERNS:
            pattern += _quoted(plain) + _PATTERNS[part]
            plain = ""
        else:
            raise ValueError(f"unsupported format directive {part!r}")
    return pattern + _quoted(plain)


def _quoted(plain: str) -> str:
    return "'" + plain.replace("'", "''") + "'" if plain else ""


def render(day: Column, fmt: str = ISO_DATE) -> Column:
    """A date as text, in a strftime format."""
    return F.date_format(day, date_pattern(fmt))


DATE_MACROS: dict[str, Callable[..., Column]] = {
    fn.__name__: fn
    for fn in (
        today,
        today_plus,
        today_minus,
        month_start,
        month_end,
        month_plus,
        month_minus,
        quarter_start,
        quarter_end,
        quarter_plus,
        quarter_minus,
        year_start,
        year_end,
        year_plus,
        year_minus,
    )
}

# SQL bodies over the anchor {d}; n is the macro's one argument. Spark inlines SQL functions into
# the plan, so a condition that uses them still reaches the scan as a plain filter.
_SQL_BODIES: dict[str, tuple[str, str]] = {
    "today": ("", "{d}"),
    "today_plus": ("days INT DEFAULT 0", "date_add({d}, days)"),
    "today_minus": ("days INT DEFAULT 0", "date_sub({d}, days)"),
    "month_start": ("", "trunc({d}, 'MM')"),
    "month_end": ("", "last_day({d})"),
    "month_plus": ("months INT DEFAULT 1", "add_months({d}, months)"),
    "month_minus": ("months INT DEFAULT 1", "add_months({d}, -months)"),
    "quarter_start": ("", "trunc({d}, 'QUARTER')"),
    "quarter_end": ("", "last_day(add_months(trunc({d}, 'QUARTER'), 2))"),
    "quarter_plus": ("quarters INT DEFAULT 1", "add_months({d}, 3 * quarters)"),
    "quarter_minus": ("quarters INT DEFAULT 1", "add_months({d}, -3 * quarters)"),
    "year_start": ("", "trunc({d}, 'YEAR')"),
    "year_end": ("", "make_date(year({d}), 12, 31)"),
    "year_plus": ("years INT DEFAULT 1", "add_months({d}, 12 * years)"),
    "year_minus": ("years INT DEFAULT 1", "add_months({d}, -12 * years)"),
}


def _formatted(day: str) -> str:
    """SQL text of a date in the strftime format that is named `format`.

    Values hold no percent sign, so one directive after the other can be replaced. With a constant format Spark folds
    it all into one literal. What is no directive of the table raises an error, which fails the rule.
    """
    text = "replace(format, '%%', chr(1))"
    for directive, pattern in _PATTERNS.items():
        text = f"replace({text}, '{directive}', date_format({day}, '{pattern}'))"
    known = f"IF(contains({text}, '%'), raise_error(concat('unsupported format ', format)), {text})"
    return f"replace({known}, chr(1), '%')"


def register_date_macros(spark: SparkSession, as_of: dt.date) -> None:
    """Define the macros as temporary SQL functions anchored at `as_of`.

    A condition may then say `o_orderdate >= month_start()` or `ts < today_minus(days => 7)`. Each macro also comes
    as text, in a format given last: `day = month_start_text('%d/%m/%Y')`, `day = today_minus_text(7, '%Y%m%d')`.
    """
    anchor = f"DATE'{as_of.isoformat()}'"
    for name, (signature, body) in _SQL_BODIES.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({signature}) RETURNS DATE "
            f"RETURN {body.format(d=anchor)}"
        )
        arguments = ", ".join(filter(None, [signature, f"format STRING DEFAULT '{ISO_DATE}'"]))
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name}_text({arguments}) RETURNS STRING "
            f"RETURN {_formatted(body.format(d=anchor))}"
        )

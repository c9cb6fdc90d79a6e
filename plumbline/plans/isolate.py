"""Keep an error that some row provokes with the check that provokes it."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame

from plumbline.sources.readers import staged

Item = TypeVar("Item")

# SQL states of class 22 are errors of the data: division by zero, overflow, a text that is no number. P0001 is what a
# condition raises itself.
_DATA_ERROR = re.compile(r"\[([A-Z][A-Z0-9_.]*)\][^\n]*(?:\n[^\n]*){0,8}?SQLSTATE: (?:22|P0001)")


def data_error(error: PySparkException | Py4JJavaError) -> str | None:
    """The condition of a data error, also of one that ended a task; None for any other failure."""
    if "PatternSyntaxException" in str(error):
        return "INVALID_PARAMETER_VALUE.PATTERN"
    if isinstance(error, PySparkException) and (error.getSqlState() or "").startswith(("22", "P0001")):
        return error.getCondition() or type(error).__name__
    found = _DATA_ERROR.search(str(error))
    return found[1] if found else None


def run_isolated(items: Sequence[Item], build: Callable[[Sequence[Item]], DataFrame]) -> tuple[list[DataFrame], dict[Item, str]]:
    """Run `build` over all items at once, and on a data error over each half, down to the bad ones.

    Returns the written results and the reason of each item that failed. Without an error this is one
    run; one bad item among n costs about log2(n) more.
    """
    if not items:
        return [], {}
    try:
        return [staged(build(items))], {}
    except (PySparkException, Py4JJavaError) as error:
        reason = data_error(error)
        if reason is None:
            raise
        if len(items) == 1:
            return [], {items[0]: reason}
    middle = len(items) // 2
    first, bad = run_isolated(items[:middle], build)
    second, worse = run_isolated(items[middle:], build)
    return first + second, {**bad, **worse}

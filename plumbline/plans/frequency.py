"""Value frequencies: how often each value of a column occurs.

Several `count(distinct …)` in one aggregate make Spark expand every row and shuffle all columns
together. Here each column is counted by a `GROUP BY` of its own, all in one job. The partial count
runs before the shuffle, so a value that fills a third of the table costs one row per task, and the
null group likewise. On columnar files every branch reads only its own column, so together the
branches read the columns once. A source that cannot skip columns should be staged first
(`plumbline.sources.staged`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from plumbline import sqltext as sql

# A binary text longer than this is counted by its digest, so that the shuffle moves keys and not
# texts. Equality is that of the bytes at every length. Texts of other collations are counted as they are.
KEY_LENGTH = 64


def countable(data_type: T.DataType) -> bool:
    return not isinstance(data_type, (T.ArrayType, T.MapType, T.StructType, T.VariantType))


def is_binary_text(data_type: T.DataType) -> bool:
    """Whether equal values of a text column have equal bytes."""
    return isinstance(data_type, T.StringType) and data_type.collation.upper() == "UTF8_BINARY"


def text_key(column: str) -> str:
    """A key of bounded length that is equal for equal texts and differs for different ones.

    Short texts stand for themselves. Long ones become a mark and a SHA-256 digest, 65 characters,
    which no short text can be.
    """
    return f"if(length({column}) <= {KEY_LENGTH}, {column}, concat('#', sha2({column}, 256)))"


def member_key(value: str, data_type: T.DataType) -> str:
    """A text that is equal for equal values of a type, whatever the type, so that values of several columns share a table."""
    if is_binary_text(data_type):
        return text_key(value)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return f"CAST({value} + 0.0D AS STRING)"  # 0.0 and -0.0 are equal
    return f"hex({value})" if isinstance(data_type, T.BinaryType) else f"CAST({value} AS STRING)"


def tally(column: str, group_by: Sequence[str] = (), where: str | None = None) -> str:
    """A subquery of rows (group columns, __v, __n) over the source; the null value is a row too."""
    return _counted(sql.name(column), group_by, where)


def key_tally(
    column: str, data_type: T.DataType, group_by: Sequence[str] = (), where: str | None = None, why: str | None = None
) -> str:
    """The same where only the counts matter: __v identifies the value but need not be it.

    `why` names a column with codes of errors: rows outside of `where` then stay, uncounted, and __w is the largest code.
    """
    value = sql.name(column)
    value = text_key(value) if is_binary_text(data_type) else value
    if not why:
        return _counted(value, group_by, where)
    groups = "".join(f"{sql.name(g)}, " for g in group_by)
    return (
        f"(SELECT {groups}{value} AS __v, count_if({where or 'true'}) AS __n, max({why}) AS __w"
        f" FROM {sql.SOURCE} GROUP BY {groups}{value})"
    )


def _counted(value: str, group_by: Sequence[str], where: str | None) -> str:
    groups = "".join(f"{sql.name(g)}, " for g in group_by)
    condition = f" WHERE {where}" if where else ""
    return f"(SELECT {groups}{value} AS __v, count(1) AS __n FROM {sql.SOURCE}{condition} GROUP BY {groups}{value})"

"""Errors of single rows as data.

A condition may hold an operation that some row makes fail: a division by zero, a text that is no number, a place beyond
the end of an array. `guarded` rewrites it into two expressions over the same row: the value, in which every such operation
is replaced by its form that yields null, and a code that says whether an operation that the condition reaches has failed,
and how. Both fit into the aggregate that counts everything else, so a bad rule costs no run of its own. What AND, OR, IF,
CASE and coalesce do not reach is no error: `a <> 0 AND 6 / a > 1` has none. A condition counts as it is written: an operation
whose value decides nothing, as in `IF(6 / a > 1, b, b)`, is reached, though Spark's optimizer may take it away elsewhere.

Spark parses the condition, and Spark's analysis of the rewritten form decides whether it is accepted: only if it holds
nothing that can fail. Other conditions are left to `plumbline.plans.isolate`.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from typing import Any

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from plumbline import sqltext as sql

# Spark's names of the conditions. The code of a row is the place in this list, from 1; of several the largest counts.
REASONS = ("ARITHMETIC_OVERFLOW", "INVALID_ARRAY_INDEX", "CAST_INVALID_INPUT", "REMAINDER_BY_ZERO", "DIVIDE_BY_ZERO")
CODES = {reason: code for code, reason in enumerate(REASONS, start=1)}

# Spark's expressions that no row can make fail, whatever their children are.
_HARMLESS = frozenset(
    "Alias And ArrayContains AttributeReference Between CaseWhen Coalesce CommonExpressionDef CommonExpressionRef Concat CreateArray "
    "Contains DateDiff DayOfMonth EndsWith EqualNullSafe EqualTo GetMapValue GetStructField GreaterThan GreaterThanOrEqual "
    "Greatest Hour If In InSet IsNaN IsNotNull IsNull Least Length LessThan LessThanOrEqual Like Literal Lower Minute Month Not "
    "NullIf OctetLength Or Size StartsWith StringTrim StringTrimLeft StringTrimRight Substring TryAdd TryDivide TryMod TryMultiply "
    "TrySubtract Upper With Year".split()
)
_ARITHMETIC = frozenset({"Add", "Subtract", "Multiply"})
_DIVISIONS = frozenset({"Divide", "Remainder"})
_COMPARISONS = frozenset("EqualTo EqualNullSafe GreaterThan GreaterThanOrEqual LessThan LessThanOrEqual".split())


@dataclass(frozen=True)
class Guarded:
    """A condition without operations that fail, and the code of its error: 0 where there is none."""

    value: str
    code: str | None = None


def reason(code: str) -> str:
    """The condition's name for a code; null for 0 and null."""
    names = ", ".join(map(sql.text, REASONS))
    return f"CASE WHEN {code} > 0 THEN element_at(array({names}), {code}) END"


def children(node: Any) -> list[Any]:
    seq = node.children()
    return [seq.apply(i) for i in range(seq.size())]


def _kind(node: Any) -> str:
    return node.getClass().getSimpleName()


def pattern_error(spark: SparkSession, pattern: Any) -> str | None:
    """The error of a pattern that cannot be compiled, or None. It is compiled here, once, as a task would."""
    try:
        spark._jvm.java.util.regex.Pattern.compile(str(pattern))
    except (Py4JError, PySparkException):
        return "INVALID_PARAMETER_VALUE.PATTERN"
    return None


def cannot_fail(node: Any, spark: SparkSession) -> bool:
    """Whether an analysed expression holds nothing that a row can make fail."""
    kind, below = _kind(node), children(node)
    if kind == "Cast":
        wide = node.evalMode().toString() == "TRY" or _widens(spark, below[0].dataType(), node.dataType())
        if not wide:
            return False
    elif kind in _ARITHMETIC:
        floating = node.dataType().simpleString() in ("double", "float")
        if not floating and node.evalMode().toString() != "TRY":
            return False
    elif kind in _DIVISIONS:
        if node.evalMode().toString() != "TRY":
            return False
    elif kind == "GetArrayItem":
        if node.failOnError():
            return False
    elif kind == "RLike":
        if _kind(below[1]) != "Literal" or pattern_error(spark, below[1].toString()):
            return False
    elif kind not in _HARMLESS and kind != "Get":
        return False
    return all(cannot_fail(c, spark) for c in below)


def _widens(spark: SparkSession, source: Any, target: Any) -> bool:
    return target.simpleString() == "string" or spark._jvm.org.apache.spark.sql.catalyst.expressions.Cast.canUpCast(source, target)


def analysed(df: DataFrame, params: Mapping[str, Any], condition: str) -> Any:
    """Spark's analysis of a condition over the table."""
    frame = sql.over(df.limit(0), f"SELECT CAST(({condition}) AS BOOLEAN) AS v FROM {sql.SOURCE}", params)
    return frame._jdf.queryExecution().analyzed().expressions().apply(0)


class _Rewriter:
    def __init__(self, df: DataFrame, params: Mapping[str, Any]):
        self.df, self.params, self.spark = df, params, df.sparkSession
        self.parser = self.spark._jsparkSession.sessionState().sqlParser()

    def parse(self, text: str) -> Any:
        return self.parser.parseExpression(text)

    def _with_children(self, node: Any, texts: list[str]) -> str:
        """The node as text, with other children."""
        parsed = self.spark._jvm.java.util.ArrayList()
        for text in texts:
            parsed.append(self.parse(text))
        seq = self.spark._jvm.org.apache.spark.api.python.PythonUtils.toSeq(parsed)
        return node.withNewChildren(seq.toIndexedSeq()).sql()

    def _is_array(self, text: str) -> bool:
        found = sql.over(self.df.limit(0), f"SELECT {_named(text)} AS v FROM {sql.SOURCE}", self.params)
        return isinstance(found.schema["v"].dataType, T.ArrayType)

    def _compared(self, node: Any, parts: list[Guarded]) -> list[Guarded]:
        """The sides of a comparison with the casts that Spark would add, where a value may be no such number or day."""
        out = []
        found = analysed(self.df, self.params, _named(node.sql()))
        sides = children(children(children(found)[0])[0] if _kind(children(found)[0]) == "Cast" else children(found)[0])
        for part, side in zip(parts, sides, strict=True):
            if _kind(side) == "Cast" and not _widens(self.spark, children(side)[0].dataType(), side.dataType()):
                value = f"try_cast({part.value} AS {side.dataType().sql()})"
                own = f"IF(({part.value}) IS NOT NULL AND {value} IS NULL, {CODES['CAST_INVALID_INPUT']}, 0)"
                part = Guarded(value, _largest([part.code, own]))
            out.append(part)
        return out

    def rewrite(self, node: Any) -> Guarded:
        kind, below = _kind(node), children(node)
        if not below:
            return Guarded(node.sql())
        parts = [self.rewrite(c) for c in below]
        if kind in _COMPARISONS:
            parts = self._compared(node, parts)
        values, codes = [p.value for p in parts], [p.code for p in parts]
        if kind in ("And", "Or"):
            # The right side is reached unless the left one decides.
            reached = f"NOT coalesce({values[0]}, false)" if kind == "Or" else f"coalesce({values[0]}, true)"
            codes[1] = codes[1] and f"IF({reached}, {codes[1]}, 0)"
        elif kind == "CaseWhen":
            codes = [self._of_branches(values, codes)]
        elif kind == "UnresolvedFunction":
            name = node.sql().partition("(")[0].lower()
            if name in ("if", "iff") and len(values) == 3:
                codes = [self._of_branches(values, codes)]
            elif name in ("coalesce", "nvl", "ifnull"):
                for k in range(1, len(codes)):
                    codes[k] = codes[k] and f"IF(coalesce({', '.join(values[:k])}) IS NULL, {codes[k]}, 0)"
        value, own = self._own(node, kind, values)
        if value is None:
            changed = any(v != c.sql() for v, c in zip(values, below, strict=True))
            value = self._with_children(node, values) if changed else node.sql()
        return Guarded(value, _largest([*codes, own]))

    @staticmethod
    def _of_branches(values: list[str], codes: list[str | None]) -> str | None:
        """The code of `CASE WHEN c THEN v … ELSE e`: of the conditions up to the one that holds, and of its value."""
        code = codes[-1] if len(values) % 2 else None
        for k in range(len(values) // 2 * 2 - 2, -1, -2):
            chosen = f"IF(coalesce({values[k]}, false), {codes[k + 1] or 0}, {code or 0})" if codes[k + 1] or code else None
            code = _largest([codes[k], chosen])
        return code

    def _own(self, node: Any, kind: str, values: list[str]) -> tuple[str | None, str | None]:
        """The form of an operation that yields null, and the code of its own failure."""

        def failed(value: str, code: str) -> str:
            known = " AND ".join(f"({v}) IS NOT NULL" for v in values)
            return f"IF({known} AND ({value}) IS NULL, {code}, 0)"

        if kind in _ARITHMETIC:
            value = f"try_{kind.lower()}({values[0]}, {values[1]})"
            return value, failed(value, str(CODES["ARITHMETIC_OVERFLOW"]))
        if kind in _DIVISIONS:
            value = f"{'try_divide' if kind == 'Divide' else 'try_mod'}({values[0]}, {values[1]})"
            zero = CODES["DIVIDE_BY_ZERO" if kind == "Divide" else "REMAINDER_BY_ZERO"]
            return value, failed(value, f"IF(({values[1]}) = 0, {zero}, {CODES['ARITHMETIC_OVERFLOW']})")
        if kind == "Cast" and node.evalMode().toString() != "TRY":
            value = f"try_cast({values[0]} AS {node.dataType().sql()})"
            return value, failed(value, str(CODES["CAST_INVALID_INPUT"]))
        if kind == "UnaryMinus":
            value = f"try_subtract(0, {values[0]})"
            return value, failed(value, str(CODES["ARITHMETIC_OVERFLOW"]))
        if kind == "UnresolvedExtractValue" and self._is_array(values[0]):
            code = CODES["INVALID_ARRAY_INDEX"]
            beyond = f"IF(({values[1]}) < 0 OR ({values[1]}) >= size({values[0]}), {code}, 0)"
            return f"get({values[0]}, {values[1]})", f"coalesce({beyond}, 0)"
        return None, None


def _largest(codes: list[str | None]) -> str | None:
    some = [c for c in codes if c]
    return f"greatest({', '.join(some)})" if len(some) > 1 else (some[0] if some else None)


# A parameter marker has no text of its own in a parsed expression; a column name stands for it meanwhile.
_MARK = re.compile(r"('(?:[^'\\]|\\.)*')|(?<!:):([A-Za-z_][A-Za-z0-9_]*)")
_STANDS_FOR = re.compile(r"`?__parameter_([A-Za-z0-9_]+)`?")


def _marked(condition: str) -> str:
    return _MARK.sub(lambda m: m[1] or f"__parameter_{m[2]}", condition)


def _named(text: str) -> str:
    return _STANDS_FOR.sub(lambda m: f":{m[1]}", text)


def guarded(df: DataFrame, condition: str, params: Mapping[str, Any] | None = None) -> Guarded | None:
    """The condition in a form that no row makes fail; None if it has an operation for which there is none."""
    params = params or {}
    try:
        if cannot_fail(analysed(df, params, condition), df.sparkSession):
            return Guarded(condition)
        rewriter = _Rewriter(df, params)
        found = rewriter.rewrite(rewriter.parse(_marked(condition)))
        found = Guarded(_named(found.value), found.code and _named(found.code))
        whole = f"{found.value}" if found.code is None else f"({found.value}) AND ({found.code}) >= 0"
        return found if cannot_fail(analysed(df, params, whole), df.sparkSession) else None
    except (PySparkException, Py4JError):
        return None

"""Ratio and statistic constraints: a metric per constraint and the range it must lie in.

All plain statistics come from one aggregate. The metrics of a column that need value frequencies
share one count of its values.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sqltext as sql
from plumbline.plans.errors import guarded, reason
from plumbline.plans.frequency import countable, key_tally
from plumbline.plans.isolate import run_isolated
from plumbline.sources.readers import columnar


@dataclass(frozen=True)
class Constraint:
    type: str | None = None
    column: str | None = None
    min: float | None = None
    max: float | None = None
    other_column: str | None = None
    constraint: str | None = None
    description: str | None = None

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any]) -> Constraint:
        return cls(**{k: v for k, v in raw.items() if k in cls.__dataclass_fields__})


SUCCESS, FAILURE, UNKNOWN = "Success", "Failure", "Unknown"

# Constraint names.
# Constraint names and their metrics over all rows. {c} is the column, {o} the other column, {p} the
# predicate. A share is null on an empty table.
_PLAIN = {
    "isComplete": "count({c}) / nullif(count(1), 0)",
    "hasCompleteness": "count({c}) / nullif(count(1), 0)",
    "isNonNegative": "(count(1) - count_if({c} < 0)) / nullif(count(1), 0)",
    "isPositive": "(count(1) - count_if({c} <= 0)) / nullif(count(1), 0)",
    "satisfies": "count_if({p}) / nullif(count(1), 0)",
    "hasMax": "max({c})",
    "hasMin": "min({c})",
    "hasStandardDeviation": "stddev_pop({c})",
    "hasMean": "avg({c})",
    "hasSum": "{sum}",
    "hasCorrelation": "corr({c}, {o})",
}

# The same over the distinct values __v of a column and their frequencies __n. For the entropy:
# -sum(n/N ln n/N) = ln N - sum(n ln n) / N.
_BY_FREQUENCY = {
    "hasUniqueness": "count_if(__v IS NOT NULL AND __n = 1) / nullif(sum(__n) FILTER (WHERE __v IS NOT NULL), 0)",
    "hasDistinctness": "count(__v) / nullif(sum(__n) FILTER (WHERE __v IS NOT NULL), 0)",
    "hasUniqueValueRatio": "count_if(__v IS NOT NULL AND __n = 1) / nullif(count(__v), 0)",
    "hasNumberOfDistinctValues": "count(__v)",
    "hasEntropy": (
        "ln(sum(__n) FILTER (WHERE __v IS NOT NULL)) - sum(__n * ln(__n)) FILTER (WHERE __v IS NOT NULL)"
        " / sum(__n) FILTER (WHERE __v IS NOT NULL)"
    ),
}

# These reckon with numbers: of another type their columns have no metric.
_NUMERIC = {
    "isNonNegative", "isPositive", "hasMax", "hasMin", "hasStandardDeviation", "hasMean", "hasSum", "hasCorrelation",
}

# Constraints that one aggregate answers at most: two fields each, of the 100 for which Spark compiles one.
CONSTRAINTS_PER_PASS = 48

# These must hold for every row, and hold for an empty table; the others have a range.
ALL_ROWS = {"isComplete", "isNonNegative", "isPositive", "satisfies"}
# Ratios with no upper bound given end at 1.
RATIOS = {"hasCompleteness", "hasUniqueness", "hasDistinctness", "hasUniqueValueRatio", "hasCorrelation"}

_DECLARED = (
    "seq int, constraint_type string, column_name string, other_column string, description string, "
    "min_value double, max_value double, message string"
)

STATUS = f"""
CASE
  WHEN message IS NOT NULL THEN '{UNKNOWN}'
  WHEN metric IS NULL AND constraint_type IN ({', '.join(map(sql.text, sorted(ALL_ROWS)))}) THEN '{SUCCESS}'
  WHEN metric >= coalesce(min_value, metric) AND metric <= coalesce(max_value, metric) THEN '{SUCCESS}'
  ELSE '{FAILURE}'
END
"""


def _sum(column: str, data_type: T.DataType) -> str:
    """A sum that no table overflows: integers as decimals of 38 digits, floating numbers as doubles."""
    if isinstance(data_type, T.IntegralType):
        return f"try_sum(CAST({column} AS DECIMAL(28, 0)))"
    return f"try_sum({column})"


def _no_number(c: Constraint, types: Mapping[str, T.DataType]) -> str | None:
    """Why a constraint that reckons with numbers has no metric, or None."""
    for column in (c.column, c.other_column) if c.type == "hasCorrelation" else (c.column,):
        if column in types and not isinstance(types[column], T.NumericType):
            return f"column {column} is {types[column].simpleString()}, not a number"
    return None


def _number(value: Any) -> float | None:
    return None if value is None else float(value)


def constraint_range(c: Constraint) -> tuple[float | None, float | None]:
    if c.type in ALL_ROWS:
        return 1.0, None
    if c.type == "hasMax":
        return None, c.max
    if c.type == "hasMin":
        return c.min, None
    return c.min, 1.0 if c.max is None and c.type in RATIOS else c.max


def _fill(template: str, c: Constraint, types: Mapping[str, T.DataType], predicate: str | None = None) -> str:
    column = sql.name(c.column or "")
    build = template.format(
        c=column, o=sql.name(c.other_column or ""), p=f"({predicate or c.constraint})", sum=_sum(column, types.get(c.column))
    )
    return f"CAST({build} AS DOUBLE)"


def check_constraints(
    df: DataFrame, constraints: Sequence[Constraint | Mapping[str, Any]], *, approximate_distinct: bool = False
) -> DataFrame:
    """One row per constraint. An unknown or unplannable constraint has status `Unknown` and a message.

    `approximate_distinct` answers `hasNumberOfDistinctValues` from a sketch in the plain pass.
    """
    asked = [c if isinstance(c, Constraint) else Constraint.from_dict(c) for c in constraints]
    if not asked:
        raise ValueError("no constraints given")
    df = columnar(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    plain: dict[int, str] = {}
    codes: dict[int, str] = {}
    by_column: dict[str, dict[int, str]] = {}
    messages: dict[int, str] = {}
    for seq, c in enumerate(asked):
        try:
            _number(c.min), _number(c.max)
        except (TypeError, ValueError):
            messages[seq] = f"bounds {c.min!r}, {c.max!r} are not numbers"
            continue
        if c.type not in _PLAIN and c.type not in _BY_FREQUENCY:
            messages[seq] = "unknown constraint type"
        elif c.type == "satisfies" and not c.constraint:
            messages[seq] = "no predicate given"
        elif c.type != "satisfies" and c.column not in types:
            messages[seq] = f"no column {c.column}"
        elif c.type in _NUMERIC and (wrong := _no_number(c, types)):
            messages[seq] = wrong
        elif c.type == "hasNumberOfDistinctValues" and approximate_distinct:
            plain[seq] = _fill("approx_count_distinct({c})", c, types)
        elif c.type in _PLAIN:
            plain[seq] = _fill(_PLAIN[c.type], c, types)
        elif countable(types[c.column]):
            by_column.setdefault(c.column, {})[seq] = _fill(_BY_FREQUENCY[c.type], c, types)
        else:
            messages[seq] = f"values of type {types[c.column].simpleString()} cannot be counted"
    for seq in _unplannable(df, plain, messages):
        del plain[seq]
    # A predicate is text of the user's and may fail on some row; that must not end the others.
    risky = []
    for seq in plain:
        if asked[seq].type == "satisfies":
            safe = guarded(df, asked[seq].constraint)
            if safe is None:
                risky.append(seq)
            else:
                plain[seq] = _fill(_PLAIN["satisfies"], asked[seq], types, safe.value)
                if safe.code:
                    codes[seq] = f"max({safe.code})"

    def counted(seqs: Sequence[int]) -> DataFrame:
        whys = [f"{codes[seq]} AS w{seq}" for seq in seqs if seq in codes]
        wide = df.selectExpr(*[f"{plain[seq]} AS m{seq}" for seq in seqs], *whys)
        records = [
            {"seq": str(seq), "metric": f"m{seq}", "why": f"CAST({f'w{seq}' if seq in codes else 'NULL'} AS INT)"} for seq in seqs
        ]
        return wide.selectExpr(sql.melted(records))

    metrics, failures = run_isolated(risky, counted)
    messages |= failures
    # Sorted, so that an aggregate reads few columns.
    order = sorted((seq for seq in plain if seq not in risky), key=lambda seq: (asked[seq].column or "", seq))
    slices = [order[i : i + CONSTRAINTS_PER_PASS] for i in range(0, len(order), CONSTRAINTS_PER_PASS)]
    metrics = metrics + [counted(part) for part in slices]
    if by_column:
        branches = [
            f"SELECT {sql.melted([{'seq': str(s), 'metric': f'm{s}', 'why': 'CAST(NULL AS INT)'} for s in wanted])} FROM ("
            f"SELECT {', '.join(f'{build} AS m{s}' for s, build in wanted.items())}"
            f" FROM {key_tally(column, types[column])})"
            for column, wanted in by_column.items()
        ]
        metrics.append(sql.over(df, " UNION ALL ".join(branches)))
    if messages:
        failed = [{"seq": seq, "metric": None, "why": None} for seq in messages]
        metrics.append(sql.local_table(df.sparkSession, failed, "seq int, metric double, why int"))
    rows = []
    for seq, c in enumerate(asked):
        low, high = (None, None) if seq in messages else constraint_range(c)
        rows.append(
            {
                "seq": seq,
                "constraint_type": c.type,
                "column_name": c.column,
                "other_column": c.other_column,
                "description": c.description,
                "min_value": None if low is None else float(low),
                "max_value": None if high is None else float(high),
                "message": messages.get(seq),
            }
        )
    # One row per constraint on both sides.
    declared = F.broadcast(sql.local_table(df.sparkSession, rows, _DECLARED))
    joined = reduce(DataFrame.unionByName, metrics).join(declared, "seq").selectExpr(
        "* EXCEPT (metric, message)",
        "CASE WHEN coalesce(why, 0) = 0 THEN metric END AS metric",
        f"coalesce(message, {reason('why')}) AS message",
    )
    return joined.selectExpr(
        "seq",
        "constraint_type",
        "column_name",
        "other_column",
        "description",
        "min_value",
        "max_value",
        "metric",
        f"{STATUS} AS constraint_status",
        "message",
    )


def _unplannable(df: DataFrame, plain: Mapping[int, str], messages: dict[int, str]) -> list[int]:
    """The constraints that Spark's analysis rejects, with the reason noted. No job runs."""
    try:
        df.selectExpr(*plain.values())
        return []
    except PySparkException:
        pass
    rejected = []
    for seq, build in plain.items():
        try:
            df.selectExpr(build)
        except PySparkException as error:
            messages[seq] = error.getCondition() or type(error).__name__
            rejected.append(seq)
    return rejected


def constraint_verdict(results: DataFrame) -> DataFrame:
    """One row: valid only if every constraint succeeded."""
    status = F.col("constraint_status")
    return results.agg(
        F.coalesce(F.bool_and(status == SUCCESS), F.lit(True)).alias("is_valid"),
        F.count(F.lit(1)).alias("constraints"),
        F.count_if(status == SUCCESS).alias("succeeded"),
        F.count_if(status == FAILURE).alias("failed"),
        F.count_if(status == UNKNOWN).alias("unknown"),
    )

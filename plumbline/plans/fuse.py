"""Compile a suite into as few passes over the table as its rules allow.

Row, null and row-count rules of one grouping become one aggregate; `row_condition` is a flag
inside that aggregate, not a filter of its own. Each uniqueness rule counts the values of its own
column in the same job. Schema rules read no data. A rule that cannot be planned yields a failed row that
names the reason, and the other rules go on. An error that some row provokes is counted in the same aggregate
(`plumbline.plans.errors`), so it costs no run of its own.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from typing import Any

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.params import bind_conditions
from plumbline.plans import registry
from plumbline import sqltext as sql
from plumbline.plans.errors import cannot_fail, pattern_error, reason
from plumbline.plans.frequency import countable, key_tally
from plumbline.plans.isolate import run_isolated
from plumbline.plans.members import TABLE, member_counts, unusable
from plumbline.plans.rules import Rule

# One aggregate carries at most this many counts, for Spark compiles no aggregate with more than 100
# fields (spark.sql.codegen.maxFields). A larger suite takes several, each with its own columns.
AGGREGATES_PER_PASS = 96
# A longer suite is planned in slices of this many rules, and the verdicts are put together.
RULES_PER_PLAN = 2_000

RESULT_COLUMNS = (
    "seq",
    "suite",
    "expectation_type",
    "column_name",
    "kwargs",
    "row_condition",
    "group_by",
    "group_key",
    "rule_id",
    "rule_name",
    "severity",
    "element_count",
    "missing_count",
    "unexpected_count",
    "unexpected_percent",
    "observed_value",
    "success",
    "exception",
)


@dataclass(frozen=True)
class Planned:
    """A rule with the part of the work it needs."""

    seq: int
    rule: Rule
    kind: str  # count | null | row | unique | member
    live: str | None = None
    predicate: Column | None = None
    data_type: T.DataType | None = None
    why: str | None = None  # the column with the code of a row's error
    risky: bool = False  # a row may make it fail, and no form is known that does not

    @property
    def passes(self) -> str:
        """The column that holds this rule's predicate."""
        return f"__passes_{self.seq}"

    @property
    def unexpected(self) -> str:
        return sql.both(self.live, f"{sql.name(self.rule.column)} IS NOT NULL", f"NOT coalesce({self.passes}, false)")


@dataclass(frozen=True)
class Finished:
    """A rule whose verdict needs no data: a schema rule, or a rule that cannot be planned."""

    seq: int
    rule: Rule
    success: bool = False
    observed: str | None = None
    exception: str | None = None


class _Aggregates:
    """The distinct aggregate columns of one pass; equal asks share one column."""

    def __init__(self) -> None:
        self.names: dict[str, str] = {}

    def ask(self, build: str) -> str:
        return self.names.setdefault(build, f"__count_{len(self.names)}")

    def columns(self) -> list[str]:
        return [f"{build} AS {name}" for build, name in self.names.items()]


def _count_where(*conditions: str | None) -> str:
    kept = [c for c in conditions if c]
    return f"count_if({sql.both(*kept)})" if kept else "count(1)"


def group_key_text(group_by: Sequence[str]) -> str:
    """The values of the group columns as JSON text; null for an ungrouped rule."""
    if not group_by:
        return "CAST(NULL AS STRING)"
    fields = ", ".join(sql.name(g) for g in group_by)
    return f"to_json(struct({fields}), map('ignoreNullFields', 'false'))"


def _counts(
    seq: int,
    key: str,
    elements: str,
    missing: str = "NULL",
    unexpected: str = "NULL",
    considered: str = "NULL",
    why: str | None = None,
):
    return {
        "seq": str(seq),
        "group_key": key,
        "element_count": elements,
        "missing_count": f"CAST({missing} AS BIGINT)",
        "unexpected_count": f"CAST({unexpected} AS BIGINT)",
        "considered": f"CAST({considered} AS BIGINT)",
        "why": f"CAST({why or 'NULL'} AS INT)",
    }


def _narrowed(bound: DataFrame, planned: Sequence[Planned], group_by: tuple[str, ...]) -> DataFrame:
    """Filter the scan when every rule of an ungrouped pass has the same condition.

    A grouped pass keeps all rows, because a group without a live row still gets its verdict.
    """
    lives = {item.live for item in planned}
    if group_by or len(lives) > 1 or None in lives or any(item.why for item in planned):
        return bound
    return bound.where(lives.pop())


def with_predicates(bound: DataFrame, planned: Sequence[Planned]) -> DataFrame:
    tests = [item.predicate.alias(item.passes) for item in planned if item.predicate is not None]
    return bound.select("*", *tests) if tests else bound


def _row_pass(bound: DataFrame, planned: Sequence[Planned], group_by: tuple[str, ...]) -> DataFrame:
    """All row, null and row-count rules of one grouping from one aggregate."""
    aggregates, records = _Aggregates(), []
    key = group_key_text(group_by)
    for item in planned:
        asks = _asks(item)
        elements, *others = map(aggregates.ask, asks[:-1] if item.why else asks)
        why = aggregates.ask(asks[-1]) if item.why else None
        if item.kind == "count":
            records.append(_counts(item.seq, key, elements, why=why))
        elif item.kind == "null":
            records.append(_counts(item.seq, key, elements, others[0], others[0], elements, why))
        else:
            records.append(_counts(item.seq, key, elements, *others, f"{elements} - {others[0]}", why))
    rows = with_predicates(_narrowed(bound, planned, group_by), planned)
    groups = [sql.name(g) for g in group_by]
    columns = aggregates.columns()
    if groups:
        summed = rows.groupBy(*groups).agg(*[F.expr(c) for c in columns])
    else:
        summed = rows.selectExpr(*columns)
    return summed.selectExpr(sql.melted(records))


def _unique_rules(bound: DataFrame, planned: Sequence[Planned]) -> DataFrame:
    """Uniqueness rules: the values of a column that occur more than once, counted and then summed.

    Rules over the same column, condition and grouping share one count. An ungrouped rule still gets
    its verdict when no row is live, and so does each live group.
    """
    shared: dict[tuple, list[Planned]] = defaultdict(list)
    for item in planned:
        shared[(item.rule.column, item.live, item.rule.group_by, item.why)].append(item)
    parts = []
    for (column, live, group_by, why), items in shared.items():
        groups = [sql.name(g) for g in group_by]
        sums = (
            "coalesce(sum(__n), 0) AS __rows",
            "coalesce(sum(__n) FILTER (WHERE __v IS NULL), 0) AS __missing",
            "coalesce(sum(__n) FILTER (WHERE __v IS NOT NULL AND __n > 1), 0) AS __repeated",
        )
        counted = key_tally(column, items[0].data_type, group_by, live, why)
        grouped = f" GROUP BY {', '.join(groups)}" if groups else ""
        if why:
            # All rows are counted, the live ones by number; a group without a live row has no verdict, but for an error.
            sums += ("max(__w) AS __why",)
            grouped += " HAVING sum(__n) > 0 OR max(__w) > 0" if groups else ""
        key = group_key_text(group_by)
        measures = ("__rows", "__missing", "__repeated", "__rows - __missing", "__why" if why else None)
        records = [_counts(i.seq, key, *measures) for i in items]
        parts.append(f"SELECT {sql.melted(records)} FROM (SELECT {', '.join([*groups, *sums])} FROM {counted}{grouped})")
    return sql.over(bound, " UNION ALL ".join(parts))


def _reason(error: Exception) -> str:
    if isinstance(error, PySparkException):
        return error.getCondition() or type(error).__name__
    if isinstance(error, KeyError):
        return f"missing parameter {error}"
    return str(error) or type(error).__name__


def _plan_rule(
    spark: SparkSession,
    fields: Mapping[str, T.DataType],
    references: Mapping[str, DataFrame],
    seq: int,
    rule: Rule,
    live: str | None,
    why: str | None,
    risky: bool,
) -> Planned | Finished:
    """What a rule needs, or its verdict when no data is needed for it."""
    name = rule.expectation_type

    def failed(reason: str) -> Finished:
        return Finished(seq, rule, exception=reason)

    missing_groups = [g for g in rule.group_by if g not in fields]
    if missing_groups:
        return failed(f"no column {', '.join(missing_groups)}")
    if name == registry.ROW_COUNT:
        try:
            registry.bounds(rule.kwargs)
        except ValueError as error:
            return failed(_reason(error))
        return Planned(seq, rule, "count", live, why=why, risky=risky)
    check = registry.row_check(name)
    if check is None and name not in registry.PLANNED_CHECKS:
        return failed(f"unknown expectation {name}")
    if rule.column is None:
        return failed("missing parameter 'column'")
    if name == registry.COLUMN_EXISTS:
        return Finished(seq, rule, success=rule.column in fields)
    if rule.column not in fields:
        return failed(f"no column {rule.column}")
    data_type = fields[rule.column]
    if name == registry.OF_TYPE:
        wanted = rule.kwargs.get("type_")
        if wanted is None:
            return failed("missing parameter 'type_'")
        return Finished(seq, rule, registry.is_of_type(data_type, str(wanted)), data_type.simpleString())
    try:
        if not 0 <= float(rule.mostly) <= 1:
            return failed(f"mostly must lie in [0, 1], not {rule.mostly}")
        if name == registry.NOT_NULL:
            return Planned(seq, rule, "null", live, why=why, risky=risky)
        if name == registry.UNIQUE:
            if not countable(data_type):
                return failed(f"values of type {data_type.simpleString()} cannot be counted")
            return Planned(seq, rule, "unique", live, data_type=data_type, why=why, risky=risky)
        if name == registry.IN_SET and TABLE in rule.kwargs:
            wrong = unusable({**rule.kwargs, "column": rule.column}, data_type, references)
            return failed(wrong) if wrong else Planned(seq, rule, "member", live, data_type=data_type, why=why, risky=risky)
        predicate = check(F.col(sql.name(rule.column)), data_type, rule.kwargs).cast("boolean")
        wrong = pattern_error(spark, rule.kwargs["regex"]) if name == registry.MATCHES else None
        if wrong:
            return failed(wrong)
    except (PySparkException, ValueError, TypeError, KeyError) as error:
        return failed(_reason(error))
    return Planned(seq, rule, "row", live, predicate, data_type, why, risky)


def _predicates_that_may_fail(bound: DataFrame, tests: Sequence[Planned]) -> set[int]:
    """The rules whose own check Spark's analysis does not show to be safe."""
    if not tests:
        return set()
    frame = bound.limit(0).select(*[item.predicate.alias(item.passes) for item in tests])
    found = frame._jdf.queryExecution().analyzed().expressions()
    return {item.seq for i, item in enumerate(tests) if not cannot_fail(found.apply(i), bound.sparkSession)}


def _analysed(bound: DataFrame, planned: list[Planned]) -> tuple[list[Planned], list[Finished]]:
    """Set apart the rules whose predicate Spark rejects. Analysis only: no job runs."""
    tests = [item for item in planned if item.predicate is not None]
    try:
        bound.select(*[item.predicate.alias(item.passes) for item in tests])
        foreign = [item for item in tests if registry.may_fail(item.rule.expectation_type)]
        unsafe = _predicates_that_may_fail(bound, foreign)
        return [replace(item, risky=True) if item.seq in unsafe else item for item in planned], []
    except PySparkException:
        pass
    good, bad = [], []
    for item in planned:
        try:
            if item.predicate is not None:
                bound.select(item.predicate)
            unsafe = registry.may_fail(item.rule.expectation_type) and _predicates_that_may_fail(bound, [item])
            good.append(replace(item, risky=True) if unsafe else item)
        except PySparkException as error:
            bad.append(Finished(item.seq, item.rule, exception=_reason(error)))
    return good, bad


def plan_rules(
    df: DataFrame,
    rules: Sequence[Rule],
    params: Mapping[str, Any] | None = None,
    nan_as_missing: bool = False,
    references: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, list[Planned], list[Finished]]:
    """Bind conditions and parameters; returns the table, the rules to run and the finished ones."""
    if not rules:
        raise ValueError("no rules given")
    table = nan_as_null(df) if nan_as_missing else df
    bound = bind_conditions(table, [r.row_condition for r in rules if r.row_condition], params)
    fields = {f.name: f.dataType for f in table.schema.fields}
    planned, finished = [], []
    for seq, rule in enumerate(rules):
        if rule.error:
            plan: Planned | Finished = Finished(seq, rule, exception=rule.error)
        elif rule.row_condition in bound.errors:
            plan = Finished(seq, rule, exception=bound.errors[rule.row_condition])
        else:
            condition = rule.row_condition
            known = bound.flags.get(condition), bound.codes.get(condition), condition in bound.risky
            plan = _plan_rule(df.sparkSession, fields, references or {}, seq, rule, *known)
        (planned if isinstance(plan, Planned) else finished).append(plan)
    planned, rejected = _analysed(bound.table, planned)
    return bound.table, planned, finished + rejected


def _asks(item: Planned) -> list[str]:
    """The counts of a row, null or row-count rule, in the order that `_row_pass` uses them."""
    asks = [_count_where(item.live)]
    if item.kind != "count":
        asks.append(_count_where(item.live, f"{sql.name(item.rule.column)} IS NULL"))
    if item.kind == "row":
        asks.append(f"count_if({item.unexpected})")
    if item.why:
        asks.append(f"max({item.why})")
    return asks


def _slices(items: Sequence[Planned]) -> Iterable[Sequence[Planned]]:
    """Rules for one aggregate each: as many as their distinct counts allow. Rules of a column stay together."""
    now: list[Planned] = []
    counts: set[str] = set()
    for item in sorted(items, key=lambda item: (item.rule.column or "", item.seq)):
        wider = counts.union(_asks(item))
        if now and len(wider) > AGGREGATES_PER_PASS:
            yield now
            now, wider = [], set(_asks(item))
        now.append(item)
        counts = wider
    if now:
        yield now


def nan_as_null(df: DataFrame) -> DataFrame:
    """Treat NaN as missing in float and double columns, as tables that came from pandas or CSV need."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    columns = [(sql.name(c), c in floats) for c in df.columns]
    return df.selectExpr(*[f"nullif({c}, CAST('NaN' AS DOUBLE)) AS {c}" if is_float else c for c, is_float in columns])


_DECLARED = (
    "seq int, suite string, expectation_type string, column_name string, kwargs string, row_condition string, "
    "group_by string, rule_id string, rule_name string, severity string, mostly string, low string, high string, "
    "fixed_success boolean, fixed_observed string, exception string"
)


def _declared(spark: SparkSession, items: Sequence[Planned | Finished]) -> DataFrame:
    """What the rules say, one row per rule."""
    rows = []
    for item in items:
        rule, done = item.rule, isinstance(item, Finished)
        low, high = (None, None) if done or item.kind != "count" else registry.bounds(rule.kwargs)
        rows.append(
            {
                "seq": item.seq,
                "suite": rule.suite,
                "expectation_type": rule.expectation_type,
                "column_name": rule.column,
                "kwargs": rule.kwargs_json,
                "row_condition": rule.row_condition,
                "group_by": ",".join(rule.group_by) or None,
                "rule_id": rule.rule_id,
                "rule_name": rule.rule_name,
                "severity": rule.severity,
                "mostly": rule.mostly,
                "low": low,
                "high": high,
                "fixed_success": item.success if done else None,
                "fixed_observed": item.observed if done else None,
                "exception": item.exception if done else None,
            }
        )
    return sql.local_table(spark, rows, _DECLARED)


# A row-count rule compares the count with its bounds, any other rule its share of expected values
# with its tolerance, in decimals so that 0.07 of 100 is exactly 7.
_SUCCESS = f"""
CASE
  WHEN why > 0 THEN false
  WHEN fixed_success IS NOT NULL THEN fixed_success
  WHEN expectation_type = '{registry.ROW_COUNT}' THEN
    (low IS NULL OR element_count >= CAST(low AS DECIMAL(38, 10)))
    AND (high IS NULL OR element_count <= CAST(high AS DECIMAL(38, 10)))
  ELSE CAST(considered - unexpected_count AS DECIMAL(19, 0))
       >= CAST(mostly AS DECIMAL(19, 18)) * CAST(considered AS DECIMAL(19, 0))
END
"""

_OBSERVED = f"CASE WHEN why > 0 THEN NULL WHEN expectation_type = '{registry.ROW_COUNT}' THEN CAST(element_count AS STRING) ELSE fixed_observed END"


def _verdicts(joined: DataFrame) -> DataFrame:
    return joined.selectExpr(
        "seq",
        "suite",
        "expectation_type",
        "column_name",
        "kwargs",
        "row_condition",
        "group_by",
        "group_key",
        "rule_id",
        "rule_name",
        "severity",
        *[f"CASE WHEN why > 0 THEN NULL ELSE {c} END AS {c}" for c in ("element_count", "missing_count", "unexpected_count")],
        "CASE WHEN considered > 0 AND coalesce(why, 0) = 0 THEN 100.0D * unexpected_count / considered END AS unexpected_percent",
        f"{_OBSERVED} AS observed_value",
        f"{_SUCCESS} AS success",
        f"coalesce(exception, {reason('why')}) AS exception",
    )


def _counted(bound: DataFrame, planned: Sequence[Planned], references: Mapping[str, DataFrame]) -> list[DataFrame]:
    """The counts of rules that can be planned: row rules by grouping and slice, then those that count values."""
    row_rules: dict[tuple[str, ...], list[Planned]] = defaultdict(list)
    unique_rules = [item for item in planned if item.kind == "unique"]
    member_rules = [item for item in planned if item.kind == "member"]
    for item in planned:
        if item.kind not in ("unique", "member"):
            row_rules[item.rule.group_by].append(item)
    counts = [_row_pass(bound, part, group_by) for group_by, items in row_rules.items() for part in _slices(items)]
    if unique_rules:
        counts.append(_unique_rules(bound, unique_rules))
    if member_rules:
        counts.append(member_counts(bound, member_rules, references, group_key_text))
    return counts


def evaluate(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    params: Mapping[str, Any] | None = None,
    nan_as_missing: bool = False,
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Apply rules to a table; one row per rule, or per rule and group for a grouped rule.

    `references` are the tables that rules name as their value sets.

    `params` binds the `:name` parameters of row conditions. A rule that some row makes fail is failed with the name of
    the error; a grouped rule is failed in the groups of such rows. Nothing runs until the result is used, but for rules
    with an operation that has no form without errors: those are run at once, so that an error stays with its own rule.
    """
    return evaluated(df, rules, params=params, nan_as_missing=nan_as_missing, references=references)[0]


def evaluated(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    params: Mapping[str, Any] | None = None,
    nan_as_missing: bool = False,
    references: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, set[int]]:
    """The result of `evaluate`, and the places of rules that have failed already."""
    if len(rules) > RULES_PER_PLAN:
        shifted, gone = [], set()
        for i in range(0, len(rules), RULES_PER_PLAN):
            some = rules[i : i + RULES_PER_PLAN]
            part, bad = evaluated(df, some, params=params, nan_as_missing=nan_as_missing, references=references)
            shifted.append(part.withColumn("seq", (F.col("seq") + i).cast("int")))
            gone |= {seq + i for seq in bad}
        return reduce(DataFrame.unionByName, shifted), gone
    known = dict(references or {})
    bound, planned, finished = plan_rules(df, rules, params, nan_as_missing, known)
    by_seq = {item.seq: item for item in planned if item.risky}
    tried, failures = run_isolated(
        list(by_seq), lambda seqs: reduce(DataFrame.unionByName, _counted(bound, [by_seq[s] for s in seqs], known))
    )
    counts = tried + _counted(bound, [item for item in planned if item.seq not in by_seq], known)
    finished = finished + [Finished(seq, by_seq[seq].rule, exception=reason) for seq, reason in failures.items()]
    planned = [item for item in planned if item.seq not in failures]
    spark = df.sparkSession
    parts = []
    if counts:
        # The rules are the bounded side (RULES_PER_PLAN); a grouped rule may have any number of groups.
        declared = F.broadcast(_declared(spark, planned))
        parts.append(_verdicts(reduce(DataFrame.unionByName, counts).join(declared, "seq")))
    if finished:
        nothing = ("element_count", "missing_count", "unexpected_count", "considered")
        without = _declared(spark, finished).selectExpr(
            "*", "CAST(NULL AS STRING) AS group_key", *[f"CAST(NULL AS BIGINT) AS {c}" for c in nothing], "CAST(NULL AS INT) AS why"
        )
        parts.append(_verdicts(without))
    return reduce(DataFrame.unionByName, parts), set(failures)

"""The outcome of table checks (schema, keys, references, freshness, …) in one common form.

Each check yields one row of its own shape. `verdict` turns it into (check_name, check_type,
is_valid, message, details), so that the outcomes of a run can be kept in one table and turned into
alerts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame

from plumbline.operators.constraints import check_constraints, constraint_verdict
from plumbline.operators.custom import custom_check
from plumbline.operators.outliers import DEFAULT_THRESHOLD, anomaly_summary
from plumbline.operators.structure import freshness, primary_key_check, reference_check, schema_diff, schema_verdict
from plumbline.operators.suite import statistics, validate
from plumbline import sqltext as sql
from plumbline.plans.rules import Rule
from plumbline.sources.readers import staged

# What was seen, per check type, in terms of the columns of the check's row.
_MESSAGES = {
    "schema_validation": "concat(missing_fields, ' fields absent, ', type_mismatches, ' of another type, ', unexpected_fields, ' not declared')",
    "pk_check": "concat(distinct_key_count, ' keys in ', total_count, ' rows, ', null_key_count, ' rows without a full key')",
    "ref_integrity_check": "concat(matched_count, ' of ', total_count, ' rows have a reference')",
    "freshness_check": "if(delay_minutes IS NULL, 'no row has a time', format_string('newest row is %.1f min old', delay_minutes))",
    "constraints": "concat(succeeded, ' of ', constraints, ' constraints hold')",
    "expectations": "concat(successful_expectations, ' of ', evaluated_expectations, ' rules hold')",
    "anomaly_check": "concat(anomaly_count, ' values stand out')",
    "custom": "coalesce(error, details, '')",
}


def verdict(row: DataFrame, check_type: str, name: str) -> DataFrame:
    """The one-row outcome of a check in the common form. `is_valid` or `success` is its verdict."""
    if check_type not in _MESSAGES:
        raise ValueError(f"unknown check type {check_type!r}")
    valid = "is_valid" if "is_valid" in row.columns else "success"
    details = ", ".join(sql.name(c) for c in row.columns if c != valid)
    return row.selectExpr(
        f"{sql.text(name)} AS check_name",
        f"{sql.text(check_type)} AS check_type",
        f"{valid} AS is_valid",
        f"{_MESSAGES[check_type]} AS message",
        f"to_json(struct({details})) AS details",
    )


def verdict_alerts(verdicts: DataFrame, *handlers: Callable[[DataFrame], Any]) -> DataFrame:
    """One alert per failed check. Each handler gets the alerts."""
    rows = verdicts.where("NOT is_valid").selectExpr("concat(check_name, ' [', check_type, ']') AS title", "message", "check_type")
    if handlers:
        rows = staged(rows)  # handlers must not run the checks again
    for handler in handlers:
        handler(rows)
    return rows


class Checks:
    """Run checks under names and keep their outcomes.

    Every method runs one check at once, and its one-row outcome is kept as a local table: reading
    it, or `verdicts` and `notify`, never runs a check again. A check that is run again under the
    same name replaces its outcome. Handlers get the alerts when `notify` is called.
    """

    def __init__(self, *handlers: Callable[[DataFrame], Any]):
        self._handlers = handlers
        self._verdicts: dict[str, DataFrame] = {}

    def _keep(self, row: DataFrame, check_type: str, name: str) -> DataFrame:
        row = row.sparkSession.createDataFrame(row.collect(), row.schema)  # one row
        self._verdicts[name] = verdict(row, check_type, name)
        return row

    def schema(self, df: DataFrame, expected, name: str = "schema_validation") -> DataFrame:
        differences = staged(schema_diff(df, expected))
        self._keep(schema_verdict(differences), "schema_validation", name)
        return differences

    def primary_key(self, df: DataFrame, key_columns: Sequence[str], name: str = "pk_check") -> DataFrame:
        return self._keep(primary_key_check(df, key_columns), "pk_check", name)

    def reference_integrity(
        self, df: DataFrame, reference_df: DataFrame, join_columns: Sequence[str], name: str = "ref_integrity_check"
    ) -> DataFrame:
        return self._keep(reference_check(df, reference_df, join_columns), "ref_integrity_check", name)

    def freshness(
        self,
        df: DataFrame,
        timestamp_column: str,
        max_delay_minutes: float = 60,
        as_of: Column | None = None,
        name: str = "freshness_check",
    ) -> DataFrame:
        return self._keep(freshness(df, timestamp_column, max_delay_minutes, as_of), "freshness_check", name)

    def expectations(self, df: DataFrame, rules: Sequence[Rule], name: str = "expectations", **options) -> DataFrame:
        results = staged(validate(df, rules, source=name, **options))
        self._keep(statistics(results), "expectations", name)
        return results

    def constraints(self, df: DataFrame, constraints: Sequence[Any], name: str = "constraints") -> DataFrame:
        results = staged(check_constraints(df, constraints))
        self._keep(constraint_verdict(results), "constraints", name)
        return results

    def anomalies(
        self,
        df: DataFrame,
        column: str,
        method: str = "zscore",
        threshold: float = DEFAULT_THRESHOLD,
        name: str = "anomaly_check",
    ) -> DataFrame:
        return self._keep(anomaly_summary(df, column, method, threshold), "anomaly_check", name)

    def custom(self, df: DataFrame, check: Callable[[DataFrame], Any], name: str = "custom_validation") -> DataFrame:
        return self._keep(custom_check(df, check, name), "custom", name)

    def verdicts(self) -> DataFrame:
        if not self._verdicts:
            raise ValueError("no check has run")
        return reduce(DataFrame.unionByName, self._verdicts.values())

    def notify(self) -> DataFrame:
        return verdict_alerts(self.verdicts(), *self._handlers)

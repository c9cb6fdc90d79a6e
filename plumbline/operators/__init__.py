from plumbline.operators.constraints import Constraint, check_constraints, constraint_verdict
from plumbline.operators.custom import custom_check
from plumbline.operators.outliers import anomaly_summary, detect_anomalies
from plumbline.operators.profile import profile
from plumbline.operators.quantiles import exact_quantiles
from plumbline.operators.structure import (
    duplicate_keys,
    flag_duplicates,
    freshness,
    missing_examples,
    primary_key_check,
    reference_check,
    schema_diff,
    schema_verdict,
    with_reference,
    without_reference,
)
from plumbline.operators.suggest import suggest_rules, suggest_suite
from plumbline.operators.suite import alerts, merge_suites, records, report, statistics, validate
from plumbline.operators.unexpected import unexpected_lists, unexpected_values

__all__ = [
    "Constraint",
    "alerts",
    "anomaly_summary",
    "check_constraints",
    "constraint_verdict",
    "custom_check",
    "detect_anomalies",
    "duplicate_keys",
    "exact_quantiles",
    "flag_duplicates",
    "freshness",
    "merge_suites",
    "missing_examples",
    "primary_key_check",
    "profile",
    "records",
    "reference_check",
    "report",
    "schema_diff",
    "schema_verdict",
    "statistics",
    "suggest_rules",
    "suggest_suite",
    "unexpected_lists",
    "unexpected_values",
    "validate",
    "with_reference",
    "without_reference",
]

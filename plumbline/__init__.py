"""Data-quality checks, profiles and rule suggestions as Spark plans."""

from plumbline.operators import (
    Constraint,
    alerts,
    check_constraints,
    constraint_verdict,
    custom_check,
    detect_anomalies,
    duplicate_keys,
    exact_quantiles,
    flag_duplicates,
    freshness,
    merge_suites,
    missing_examples,
    primary_key_check,
    profile,
    records,
    reference_check,
    report,
    schema_diff,
    statistics,
    suggest_rules,
    suggest_suite,
    unexpected_lists,
    unexpected_values,
    validate,
    with_reference,
    without_reference,
)
from plumbline.operators.sources_run import validate_sources
from plumbline.operators.states import check_states, column_states, merged_states, store_states, stored_states
from plumbline.operators.verdicts import Checks
from plumbline.plans import Rule, expectation, rules_from_config, rules_from_frame
from plumbline.session import build_session
from plumbline.sources import resolve_source, staged
from plumbline.streaming import validate_stream

__all__ = [
    "Checks",
    "Constraint",
    "Rule",
    "alerts",
    "build_session",
    "check_constraints",
    "check_states",
    "column_states",
    "constraint_verdict",
    "custom_check",
    "detect_anomalies",
    "duplicate_keys",
    "exact_quantiles",
    "expectation",
    "flag_duplicates",
    "freshness",
    "merge_suites",
    "merged_states",
    "missing_examples",
    "primary_key_check",
    "profile",
    "records",
    "reference_check",
    "report",
    "resolve_source",
    "rules_from_config",
    "rules_from_frame",
    "schema_diff",
    "staged",
    "statistics",
    "store_states",
    "stored_states",
    "suggest_rules",
    "suggest_suite",
    "unexpected_lists",
    "unexpected_values",
    "validate",
    "validate_sources",
    "validate_stream",
    "with_reference",
    "without_reference",
]

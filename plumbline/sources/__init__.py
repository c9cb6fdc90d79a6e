from plumbline.sources.readers import (
    day_predicates,
    jdbc_options,
    limited_batch,
    read_csv,
    read_csv_as_text,
    read_jdbc,
    read_jdbc_by_day,
    read_json,
    resolve_source,
    staged,
)
from plumbline.sources.suites import load_rules, read_rule_table, read_suite

__all__ = [
    "day_predicates",
    "jdbc_options",
    "limited_batch",
    "load_rules",
    "read_csv",
    "read_csv_as_text",
    "read_jdbc",
    "read_jdbc_by_day",
    "read_json",
    "read_rule_table",
    "read_suite",
    "resolve_source",
    "staged",
]

"""Suites and rule tables as sources."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.rules import Rule, normalise_rule_table, parse_suite_documents, rules_from_frame
from plumbline.sources.readers import read_jdbc


def read_suite(spark: SparkSession, path: str) -> DataFrame:
    """Suite rows from JSON suite documents, in any of the accepted rule shapes."""
    return parse_suite_documents(spark.read.text(path, wholetext=True))


def load_rules(rows: DataFrame, suite: str) -> list[Rule]:
    """The rules of one named suite among suite rows, ready to be applied."""
    rules = rules_from_frame(rows.where(F.col("suite") == suite))
    if not rules:
        raise LookupError(f"no suite {suite!r}")
    return rules


def read_rule_table(spark: SparkSession, database: Mapping[str, Any], suite: str) -> tuple[DataFrame, DataFrame]:
    """Suite rows and rejected rows from a rule table in a database."""
    return normalise_rule_table(read_jdbc(spark, database), suite)

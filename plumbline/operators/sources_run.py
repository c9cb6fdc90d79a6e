"""Validate several sources in one run."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from plumbline import sqltext as sql
from plumbline.operators.profile import profile
from plumbline.operators.suggest import suggest_rules
from plumbline.operators.suite import statistics, validate
from plumbline.plans.rules import Rule, rules_from_frame
from plumbline.sources.readers import columnar, resolve_source, staged
from plumbline.sources.writers import write_reports, write_suite

log = logging.getLogger(__name__)


class SourceRun:
    """The outcome of a run: verdicts of all sources, profiles and proposed suites of those without rules."""

    def __init__(
        self,
        spark: SparkSession,
        results: DataFrame | None,
        profiles: dict[str, DataFrame],
        suggested: dict[str, DataFrame],
        failures: dict[str, str],
        validated: list[str],
    ):
        self.spark = spark
        self.results = results
        self.profiles = profiles
        self.suggested = suggested
        self.failures = failures
        self.validated = validated
        self._settled = False

    def outcomes(self) -> DataFrame:
        """One row per source: whether it was validated, profiled or failed, and why it failed."""
        rows = [{"source": name, "outcome": "validated", "reason": None} for name in self.validated]
        rows += [{"source": n, "outcome": "profiled", "reason": None} for n in self.profiles if n not in self.validated]
        rows += [{"source": name, "outcome": "failed", "reason": reason} for name, reason in self.failures.items()]
        return sql.local_table(self.spark, rows, "source string, outcome string, reason string")

    def settled(self) -> DataFrame:
        """The verdicts as a written table, so that a summary and reports together check the data once."""
        if self.results is None:
            raise ValueError("no source had rules")
        if not self._settled:
            self.results, self._settled = staged(self.results), True
        return self.results

    def summary(self) -> DataFrame:
        """Run statistics per source."""
        return statistics(self.settled(), "source")

    def write(self, folder: str, run_time: str) -> None:
        """Reports and summary per source under `folder/run_time`, proposed suites under `folder/expectations`."""
        for name, rules in self.suggested.items():
            write_suite(rules, f"{folder}/expectations/{name}_expectations")
        if self.results is not None:
            write_reports(self.settled(), f"{folder}/{run_time}/reports")
            self.summary().write.json(f"{folder}/{run_time}/summary")
        for name, profiled in self.profiles.items():
            profiled.write.json(f"{folder}/{run_time}/profiles/{name}")


def validate_sources(
    spark: SparkSession,
    sources: Mapping[str, DataFrame | str | Mapping[str, Any]],
    rules: Mapping[str, Sequence[Rule]],
    *,
    auto_suggest: bool = False,
    apply_suggested: bool = False,
    params: Mapping[str, Any] | None = None,
    references: Mapping[str, DataFrame] | None = None,
) -> SourceRun:
    """Apply each source's rules. A source without rules is profiled, and rules are proposed if asked.

    A text or database source is copied to the shared folder first, so that it is read once however
    many passes the checks take. Proposed rules are returned for review; with `apply_suggested` they also run. A source that
    cannot be read (an absent table or file, an unknown format, a database that does not answer) is logged, left out of the
    verdicts and named with its reason in `failures` and `outcomes`; the other sources go on.
    """
    results, profiles, suggested, failures = {}, {}, {}, {}
    for name, config in sources.items():
        try:
            table = columnar(resolve_source(spark, config))
        except (ValueError, TypeError, AttributeError, FileNotFoundError, PySparkException, Py4JJavaError) as error:
            log.error("source %s is left out: %s", name, error)
            failures[name] = _reason(error)
            continue
        own = list(rules.get(name) or [])
        if not own:
            profiles[name] = profile(table)
            if auto_suggest or apply_suggested:
                suggested[name] = suggest_rules(profiles[name], f"{name}_suite")
            if apply_suggested:
                own = rules_from_frame(suggested[name])
        if own:
            results[name] = validate(table, own, source=name, params=params, references=references)
    together = reduce(DataFrame.unionByName, results.values()) if results else None
    return SourceRun(spark, together, profiles, suggested, failures, list(results))


def _reason(error: Exception) -> str:
    """The name of an error of Spark's, the class of one of a driver for a database, or the text of one of ours."""
    if isinstance(error, PySparkException):
        return error.getCondition() or type(error).__name__
    if isinstance(error, Py4JJavaError):
        return error.java_exception.getClass().getName()
    return str(error) or type(error).__name__

"""Rules whose value set is a table.

Membership depends on a value alone, so rows are never joined: each column is counted by value first, as for uniqueness, and
the counts of all columns meet the members of all sets in one join. A value that fills a third of the table is one row there,
and a suite of a hundred sets has one join. Spark broadcasts the members if they are few, and otherwise deals both sides by value.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sqltext as sql
from plumbline.plans.frequency import countable, key_tally, member_key

# Parameters of a rule that name the table and its column; without a column it is that of the rule.
TABLE, COLUMN = "value_table", "value_column"

COUNTS = (
    "seq int, group_key string, element_count bigint, missing_count bigint, unexpected_count bigint, considered bigint, why int"
)


def member_column(kwargs: Mapping[str, Any]) -> str:
    return kwargs.get(COLUMN) or kwargs["column"]


def unusable(kwargs: Mapping[str, Any], data_type: T.DataType, references: Mapping[str, DataFrame]) -> str | None:
    """Why a set that is a table cannot be used, or None."""
    name = kwargs[TABLE]
    if name not in references:
        return f"no reference table {name}"
    if member_column(kwargs) not in references[name].columns:
        return f"no column {member_column(kwargs)} in {name}"
    if not countable(data_type):
        return f"values of type {data_type.simpleString()} cannot be counted"
    return None


class Sets:
    """The sets of a suite, each once per type of the column that it is compared with."""

    def __init__(self, references: Mapping[str, DataFrame]):
        self.references = references
        self.places: dict[tuple[str, str, str], int] = {}

    def place(self, kwargs: Mapping[str, Any], data_type: T.DataType) -> int:
        return self.places.setdefault((kwargs[TABLE], member_column(kwargs), data_type.simpleString()), len(self.places))

    def members(self, types: Mapping[str, T.DataType]) -> DataFrame:
        """member, in_sets: every member with the places of the sets that hold it. Nulls, and what is no such value, are no members."""
        parts = []
        for (name, column, type_name), place in self.places.items():
            value = member_key(f"try_cast({sql.name(column)} AS {type_name})", types[type_name])
            parts.append(self.references[name].selectExpr(f"{value} AS member", f"{place} AS place"))
        every = reduce(DataFrame.unionByName, parts).where("member IS NOT NULL")
        return every.groupBy("member").agg(F.collect_set("place").alias("in_sets"))


def member_counts(bound: DataFrame, planned: Sequence[Any], references: Mapping[str, DataFrame], key_of) -> DataFrame:
    """The counts (COUNTS) of rules with tables for sets. `key_of` gives the text of a group from its columns."""
    sets, shared, types = Sets(references), defaultdict(list), {}
    for item in planned:
        types[item.data_type.simpleString()] = item.data_type
        shared[(item.rule.column, item.live, item.rule.group_by, item.why)].append(item)
    tallies, asked = [], []
    for branch, ((column, live, group_by, why), items) in enumerate(shared.items()):
        kind = items[0].data_type
        counted = key_tally(column, kind, group_by, live, why)
        value = "__v" if isinstance(kind, T.StringType) else member_key("__v", kind)
        code, rows = ("__w", " WHERE __n > 0 OR __w > 0") if why else ("CAST(NULL AS INT)", "")
        tallies.append(
            f"SELECT {branch} AS branch, {key_of(group_by)} AS group_key, {value} AS value, __n AS n, {code} AS code FROM {counted}{rows}"
        )
        rules = ", ".join(f"struct({i.seq} AS seq, {sets.place(i.rule.kwargs, kind)} AS place)" for i in items)
        asked.append(f"WHEN {branch} THEN array({rules})")
    values = sql.over(bound, " UNION ALL ".join(tallies))
    met = values.join(sets.members(types), F.col("value") == F.col("member"), "left")
    each = met.selectExpr("group_key", "value", "n", "code", "in_sets", f"inline(CASE branch {' '.join(asked)} END)")
    counts = each.selectExpr(
        "seq",
        "group_key",
        "n AS element_count",
        "IF(value IS NULL, n, 0) AS missing_count",
        "IF(value IS NOT NULL AND NOT coalesce(array_contains(in_sets, place), false), n, 0) AS unexpected_count",
        "IF(value IS NULL, 0, n) AS considered",
        "code AS why",
    )
    # An ungrouped rule has a verdict even if there is no row.
    nothing = [{"seq": i.seq, "element_count": 0, "missing_count": 0, "unexpected_count": 0, "considered": 0} for i in planned if not i.rule.group_by]
    if nothing:
        counts = counts.unionByName(sql.local_table(bound.sparkSession, nothing, COUNTS))
    sums = [F.sum(c).alias(c) for c in ("element_count", "missing_count", "unexpected_count", "considered")]
    return counts.groupBy("seq", "group_key").agg(*sums, F.max("why").alias("why"))


def strangers(bound: DataFrame, item: Any, references: Mapping[str, DataFrame]) -> DataFrame:
    """The values (group columns, __v, __n) of one rule that its set lacks."""
    kind, column = item.data_type, item.rule.column
    sets = Sets(references)
    sets.place(item.rule.kwargs, kind)
    groups = [sql.name(g) for g in item.rule.group_by]
    live = bound.where(item.live) if item.live else bound
    value = sql.name(column)
    counted = live.where(f"{value} IS NOT NULL").groupBy(*groups, F.expr(value).alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    keyed = counted.withColumn("__member", F.expr(member_key("__v", kind)))
    return keyed.join(sets.members({kind.simpleString(): kind}), F.col("__member") == F.col("member"), "left_anti").drop("__member")

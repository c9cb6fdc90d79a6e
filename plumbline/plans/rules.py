"""Rules as immutable values and as rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.scalars import split_list


DEFAULT_SUITE = "default_suite"
DEFAULT_RULE_NAME = "N/A"
DEFAULT_SEVERITY = "Medium"

# Keys of a flat rule that describe the rule and are not parameters of the check.
META_KEYS = (
    "expectation_type",
    "type",
    "kwargs",
    "meta",
    "rule_id",
    "rule_name",
    "severity",
    "row_condition",
    "group_by",
)

RULE_SCHEMA = T.StructType(
    [
        T.StructField("suite", T.StringType(), False),
        T.StructField("expectation_type", T.StringType(), True),
        T.StructField("column_name", T.StringType(), True),
        T.StructField("kwargs", T.StringType(), True),
        T.StructField("row_condition", T.StringType(), True),
        T.StructField("group_by", T.ArrayType(T.StringType()), True),
        T.StructField("rule_id", T.StringType(), True),
        T.StructField("rule_name", T.StringType(), True),
        T.StructField("severity", T.StringType(), True),
    ]
)


def _plain(value: Any) -> Any:
    """Numbers as canonical JSON writes them: 1.0 is 1."""
    if isinstance(value, float) and value.is_integer():
        return int(value)
    if isinstance(value, Mapping):
        return {key: _plain(item) for key, item in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(item) for item in value]
    return value


def kwargs_text(kwargs: Mapping[str, Any]) -> str:
    return json.dumps(_plain(kwargs), sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _object(given: Any, name: str) -> tuple[dict[str, Any], str | None]:
    """Parameters as a dict; for what is no JSON object an empty one and the reason."""
    try:
        found = json.loads(given) if isinstance(given, str) else given
        if isinstance(found, Mapping):
            return dict(found), None
    except ValueError:
        pass
    return {}, f"{name} is not a JSON object"


def _names(value: str | Sequence[str] | None) -> tuple[str, ...]:
    if not value:
        return ()
    parts = value.split(",") if isinstance(value, str) else value
    return tuple(part.strip() for part in parts if part.strip())


@dataclass(frozen=True)
class Rule:
    """One declared check. `kwargs_json` is canonical, so equal rules have equal text."""

    expectation_type: str | None
    kwargs_json: str = "{}"
    suite: str = DEFAULT_SUITE
    row_condition: str | None = None
    group_by: tuple[str, ...] = ()
    rule_id: str | None = None
    rule_name: str = DEFAULT_RULE_NAME
    severity: str = DEFAULT_SEVERITY
    error: str | None = None  # why the declaration cannot be read; the rule then fails with it

    @property
    def kwargs(self) -> dict[str, Any]:
        return json.loads(self.kwargs_json)

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column")

    @property
    def mostly(self) -> str:
        return str(self.kwargs.get("mostly", 1))

    @classmethod
    def make(cls, expectation_type: str, /, **kwargs: Any) -> Rule:
        """`Rule.make("expect_column_values_to_be_between", column="age", min_value=18)`."""
        return cls.from_dict({"expectation_type": expectation_type, "kwargs": kwargs})

    @classmethod
    def from_dict(cls, raw: Mapping[str, Any], suite: str = DEFAULT_SUITE) -> Rule:
        """Accept nested kwargs, flat kwargs, `type` in place of `expectation_type`, and table rows.

        Parameters that are no JSON object give a rule that fails with that reason.
        """
        outer, error = raw, None
        if "rule_params" in raw:
            kwargs, error = _object(raw["rule_params"] or {}, "rule_params")
            kwargs.setdefault("column", raw.get("column_name"))
        elif raw.get("kwargs") is not None:
            kwargs, error = _object(raw["kwargs"], "kwargs")
        else:
            kwargs = {k: v for k, v in raw.items() if k not in META_KEYS}
        if kwargs.get("column", "") is None:
            kwargs.pop("column")
        meta = {**(raw.get("meta") or {}), **{k: v for k, v in outer.items() if v is not None}}
        condition = kwargs.pop("row_condition", None) or outer.get("row_condition")
        group_by = kwargs.pop("group_by", None) or outer.get("group_by")
        rule_id = meta.get("rule_id")
        return cls(
            expectation_type=raw.get("expectation_type") or raw.get("type"),
            kwargs_json=kwargs_text(kwargs),
            suite=suite,
            row_condition=condition or None,
            group_by=_names(group_by),
            rule_id=None if rule_id is None else str(rule_id),
            rule_name=meta.get("rule_name") or DEFAULT_RULE_NAME,
            severity=meta.get("severity") or DEFAULT_SEVERITY,
            error=error,
        )

    def where(self, row_condition: str) -> Rule:
        return replace(self, row_condition=row_condition)

    def by(self, *columns: str) -> Rule:
        return replace(self, group_by=columns)


def rules_from_config(config: Mapping[str, Any] | Iterable[Mapping[str, Any]], suite: str | None = None) -> list[Rule]:
    """The rules of a suite document, or of a bare list of rules."""
    if isinstance(config, Mapping):
        name = suite or config.get("expectation_suite_name") or config.get("name") or DEFAULT_SUITE
        items = config.get("expectations") or []
    else:
        name, items = suite or DEFAULT_SUITE, list(config)
    return [Rule.from_dict(item, name) for item in items]


def rules_by_source(config: Mapping[str, Any]) -> dict[str, list[Rule]]:
    """The per-source rule map of a configuration: `{"expectations": {source: [rule, …]}}`."""
    return {
        source: rules_from_config(items, suite=source)
        for source, items in (config.get("expectations") or {}).items()
    }


def digest(*parts: Column | str) -> Column:
    """A key that depends only on the parts, so that every run and every node agrees.

    128 bits, because tables of grouped verdicts can have more rows than 64 bits keep apart.
    """
    return F.md5(F.to_json(F.array(*[F.coalesce(F.col(p) if isinstance(p, str) else p, F.lit("")) for p in parts])))


def expectation_id() -> Column:
    """The key of a rule row: what the rule says."""
    return digest("suite", "expectation_type", "kwargs", "row_condition", F.concat_ws(",", "group_by"))


def rules_to_frame(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    rows = [
        (
            r.suite,
            r.expectation_type,
            r.column,
            r.kwargs_json,
            r.row_condition,
            list(r.group_by),
            r.rule_id,
            r.rule_name,
            r.severity,
        )
        for r in rules
    ]
    return spark.createDataFrame(rows, RULE_SCHEMA).withColumn("expectation_id", expectation_id())


# Other names that rule tables have for the same columns.
_COLUMN_NAMES = {
    "ExpectationType": "expectation_type",
    "ColumnName": "column_name",
    "Parameters": "rule_params",
    "ExpectationName": "rule_name",
    "kwargs": "rule_params",
}


def normalise_rule_table(table: DataFrame, suite: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Turn a rule table into suite rows; returns (accepted, rejected).

    The suite name is the argument, else the table's own `suite` column, else the default.
    Missing optional columns get their defaults. `column_name` fills in a `column` parameter that
    is absent. A row whose parameters are not a JSON object, or which names no rule, is rejected
    with a reason and the rest go on.
    """
    table = table.withColumnsRenamed({old: new for old, new in _COLUMN_NAMES.items() if new not in table.columns})
    have = set(table.columns)

    def optional(name: str, default: str | None = None) -> Column:
        col = F.col(name).cast("string") if name in have else F.lit(None).cast("string")
        return col if default is None else F.coalesce(col, F.lit(default))

    if "group_by" not in have:
        groups = F.array().cast("array<string>")
    elif isinstance(table.schema["group_by"].dataType, T.ArrayType):
        groups = F.transform("group_by", lambda name: F.trim(name))
    else:
        groups = split_list(F.col("group_by"))

    params = F.when(optional("rule_params").isNull(), F.lit("{}")).otherwise(optional("rule_params"))
    parsed = table.select(
        "*",
        F.try_parse_json(params).alias("__variant"),
    ).withColumn(
        "__is_object",
        F.coalesce(F.expr("schema_of_variant(__variant)").startswith("OBJECT"), F.lit(False)),
    )
    named = F.expr(
        "to_json(map_from_entries(array_sort(map_entries(map_concat("
        "  map_filter(CAST(if(__is_object, __variant, parse_json('{}')) AS MAP<STRING, VARIANT>),"
        "             (k, v) -> k NOT IN ('column', 'row_condition', 'group_by')),"
        "  if(__column IS NULL, CAST(parse_json('{}') AS MAP<STRING, VARIANT>),"
        "     map('column', CAST(__column AS VARIANT)))"
        ")), (x, y) -> CASE WHEN x.key < y.key THEN -1 WHEN x.key > y.key THEN 1 ELSE 0 END)))"
    )
    inner_condition = F.expr("try_variant_get(__variant, '$.row_condition', 'string')")
    inner_groups = F.coalesce(
        F.transform(F.expr("try_variant_get(__variant, '$.group_by', 'array<string>')"), lambda name: F.trim(name)),
        split_list(F.expr("try_variant_get(__variant, '$.group_by', 'string')")),
    )
    groups = F.when(F.size(F.coalesce(groups, F.array().cast("array<string>"))) > 0, groups).otherwise(inner_groups)
    rows = (
        parsed.withColumn(
            "__column",
            F.coalesce(F.expr("try_variant_get(__variant, '$.column', 'string')"), optional("column_name")),
        )
        .withColumn("__kwargs", named)
        .select(
            (F.lit(suite) if suite else optional("suite", DEFAULT_SUITE)).alias("suite"),
            optional("expectation_type").alias("expectation_type"),
            F.col("__column").alias("column_name"),
            F.col("__kwargs").alias("kwargs"),
            F.coalesce(F.nullif(optional("row_condition"), F.lit("")), inner_condition).alias("row_condition"),
            F.coalesce(groups, F.array().cast("array<string>")).alias("group_by"),
            optional("rule_id").alias("rule_id"),
            optional("rule_name", DEFAULT_RULE_NAME).alias("rule_name"),
            optional("severity", DEFAULT_SEVERITY).alias("severity"),
            F.when(~F.col("__is_object"), F.lit("rule_params is not a JSON object"))
            .when(F.coalesce(optional("expectation_type"), F.lit("")) == "", F.lit("expectation_type is missing"))
            .alias("reason"),
        )
    )
    accepted = rows.where("reason IS NULL").drop("reason").withColumn("expectation_id", expectation_id())
    rejected = rows.where("reason IS NOT NULL").select("rule_id", "rule_name", "expectation_type", "reason")
    return accepted, rejected


def rules_from_frame(frame: DataFrame) -> list[Rule]:
    """Read suite rows back as rules, partition by partition. Rows are rules: metadata, not data."""
    rows = frame.select([f.name for f in RULE_SCHEMA]).toLocalIterator()
    return [
        Rule(
            expectation_type=r["expectation_type"],
            kwargs_json=kwargs_text(json.loads(r["kwargs"] or "{}")),
            suite=r["suite"],
            row_condition=r["row_condition"],
            group_by=tuple(r["group_by"] or ()),
            rule_id=r["rule_id"],
            rule_name=r["rule_name"] or DEFAULT_RULE_NAME,
            severity=r["severity"] or DEFAULT_SEVERITY,
        )
        for r in rows
    ]


def parse_suite_documents(raw: DataFrame, column: str = "value") -> DataFrame:
    """Suite rows from JSON documents (one suite per row), in any of the accepted rule shapes."""
    flat_keys = ", ".join(f"'{key}'" for key in (*META_KEYS, "rule_params", "column_name"))
    exploded = raw.select(F.try_parse_json(F.col(column)).alias("doc")).select(
        F.coalesce(
            F.expr("try_variant_get(doc, '$.expectation_suite_name', 'string')"),
            F.expr("try_variant_get(doc, '$.name', 'string')"),
            F.lit(DEFAULT_SUITE),
        ).alias("suite"),
        F.explode(F.expr("variant_get(doc, '$.expectations', 'array<variant>')")).alias("item"),
    )

    def text(path: str) -> str:
        return f"try_variant_get(item, '$.{path}', 'string')"

    def names(path: str) -> str:
        return f"array_join(try_variant_get(item, '$.{path}', 'array<string>'), ','), {text(path)}"

    shaped = exploded.select(
        "suite",
        F.expr(f"coalesce({text('expectation_type')}, {text('type')})").alias("expectation_type"),
        F.expr(
            "coalesce(to_json(variant_get(item, '$.kwargs', 'variant')), "
            f"to_json(map_filter(CAST(item AS MAP<STRING, VARIANT>), (k, v) -> k NOT IN ({flat_keys}))))"
        ).alias("rule_params"),
        F.expr(f"coalesce({text('row_condition')}, {text('kwargs.row_condition')})").alias("row_condition"),
        F.expr(f"coalesce({names('group_by')}, {names('kwargs.group_by')})").alias("group_by"),
        F.expr(f"coalesce({text('meta.rule_id')}, {text('rule_id')})").alias("rule_id"),
        F.expr(f"coalesce({text('meta.rule_name')}, {text('rule_name')})").alias("rule_name"),
        F.expr(f"coalesce({text('meta.severity')}, {text('severity')})").alias("severity"),
    )
    accepted, _ = normalise_rule_table(shaped)
    return accepted


__all__ = [
    "DEFAULT_SUITE",
    "RULE_SCHEMA",
    "Rule",
    "expectation_id",
    "kwargs_text",
    "normalise_rule_table",
    "parse_suite_documents",
    "rules_by_source",
    "rules_from_config",
    "rules_from_frame",
    "rules_to_frame",
]

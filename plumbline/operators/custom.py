"""Checks written as functions over the DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def custom_check(df: DataFrame, check: Callable[[DataFrame], Any], name: str = "custom_validation") -> DataFrame:
    """Run a check and return one verdict row (name, is_valid, details, error).

    The check returns a one-row DataFrame or a mapping of aggregate Columns, which stay in Spark, or
    a plain mapping or value. Without an `is_valid` of its own a check is valid if its `result` is
    true. A check that raises is invalid, with the error noted.
    """
    spark = df.sparkSession

    def verdict(frame: DataFrame) -> DataFrame:
        fields = frame.columns
        if "is_valid" in fields:
            valid = F.col("is_valid").cast("boolean")
        elif "result" in fields:
            valid = F.col("result").cast("boolean")
        else:
            valid = F.lit(False)
        others = [F.col(f"`{c}`") for c in fields if c != "is_valid"]
        details = F.to_json(F.struct(*others)) if others else F.lit(None).cast("string")
        return frame.select(
            F.lit(name).alias("name"),
            F.coalesce(valid, F.lit(False)).alias("is_valid"),
            details.alias("details"),
            F.lit(None).cast("string").alias("error"),
        )

    try:
        answer = check(df)
        if isinstance(answer, DataFrame):
            return verdict(answer)
        if not isinstance(answer, Mapping):
            answer = {"result": answer}
        columns = [v if isinstance(v, Column) else F.lit(v) for v in answer.values()]
        named = [c.alias(k) for k, c in zip(answer, columns)]
        if any(isinstance(v, Column) for v in answer.values()):
            return verdict(df.agg(*named))
        frame = spark.range(1).select(*named)
        if "is_valid" not in answer:
            frame = frame.withColumn("is_valid", F.lit(bool(answer.get("result", False))))
        return verdict(frame)
    except Exception as error:  # the check is foreign code: whatever it raises is its verdict
        return spark.range(1).select(
            F.lit(name).alias("name"),
            F.lit(False).alias("is_valid"),
            F.lit(None).cast("string").alias("details"),
            F.lit(f"{type(error).__name__}: {error}").alias("error"),
        )

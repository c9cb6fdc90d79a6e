"""Rows whose value lies far from the rest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_THRESHOLD = 3.0


def detect_anomalies(
    df: DataFrame, column: str, method: str = "zscore", threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """The rows more than `threshold` sample standard deviations from the mean, with their score.

    NaN is a missing value here: it is neither scored nor part of the mean and deviation, and so is no anomaly. The mean and deviation are one row, read by the scan as a scalar; the rows are not shuffled.
    """
    if method != "zscore":
        raise ValueError(f"unknown method {method!r}")
    value = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType)):
        value = F.nanvl(value, F.lit(None))
    stats = df.agg(F.struct(F.avg(value).alias("mean"), F.nullif(F.stddev(value), F.lit(0.0)).alias("spread")).alias("stats"))
    known = stats.select("stats").scalar()
    score = F.abs(value - known["mean"]) / known["spread"]
    return df.withColumn("zscore", score).where(F.col("zscore") > threshold)


def anomaly_summary(
    df: DataFrame, column: str, method: str = "zscore", threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """One row: how many values are anomalous, and the verdict that none is."""
    found = F.count(F.lit(1))
    return detect_anomalies(df, column, method, threshold).agg(
        (found == 0).alias("is_valid"),
        found.alias("anomaly_count"),
        F.min(f"`{column}`").alias("lowest"),
        F.max(f"`{column}`").alias("highest"),
        F.max("zscore").alias("highest_zscore"),
    )

"""Validate a stream batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plumbline.operators.suite import validate
from plumbline.plans.rules import Rule
from plumbline.sources.readers import staged


def validate_stream(
    stream: DataFrame,
    rules: Sequence[Rule],
    path: str,
    checkpoint: str,
    *,
    source: str,
    params: Mapping[str, Any] | None = None,
    on_batch: Callable[[DataFrame, int], Any] | None = None,
    trigger: Mapping[str, Any] | None = None,
) -> StreamingQuery:
    """Apply a suite to every micro-batch and store the verdicts under `path/batch_identifier=N`.

    A batch that is repeated after a failure overwrites its own folder, so its verdicts are stored
    once. By default the stream ends when the available data is used up.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        # A batch is computed again by every pass over it; the copy is computed once.
        results = validate(staged(batch), rules, source=source, params=params)
        folder = f"{path}/batch_identifier={batch_id}"
        results.write.mode("overwrite").parquet(folder)
        if on_batch:
            on_batch(batch.sparkSession.read.parquet(folder), batch_id)

    writer = stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def stream_results(spark: SparkSession, path: str) -> DataFrame:
    """The stored verdicts of all batches."""
    return spark.read.parquet(path).withColumn("batch_identifier", F.col("batch_identifier").cast("bigint"))

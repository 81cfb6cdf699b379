"""Streams: pages and captures as they arrive. The batch operators do the work of each micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docloom.config import Config
from docloom.operators.clean import clean_pages


def clean_stream(pages: DataFrame, out: str, checkpoint: str, config: Config = Config()) -> StreamingQuery:
    """Clean pages of a stream and add them to the folder ``out``, one sub-folder for each micro-batch.

    A batch that is run again after a failure overwrites its own folder, so that no page is written twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        clean_pages(batch, config).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return pages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_outcomes(captures: DataFrame) -> DataFrame:
    """Captures by day, version and outcome, as a running aggregate."""
    at = F.to_timestamp("fetched_at")
    return captures.groupBy(F.window(at, "1 day").alias("w"), "version", F.col("error").isNull().alias("ok")).agg(F.count(F.lit(1)).alias("n"))


def run_to_table(stream: DataFrame, out: str, checkpoint: str, finish: Callable[[DataFrame], DataFrame] = lambda x: x) -> StreamingQuery:
    """Keep the whole result of a streaming aggregate in ``out``; late rows change what was there."""

    def write(batch: DataFrame, _: int) -> None:
        finish(batch).write.mode("overwrite").parquet(out)

    return stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_arriving(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Parquet files below a folder, or matching a path, as a stream."""
    return spark.readStream.schema(schema).parquet(path)

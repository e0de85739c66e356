"""Scoring a stream with a fitted model.

Every fitted model is a projection, so its ``transform`` takes a streaming
DataFrame unchanged. These helpers only open a file stream and run it to the
end of the files present.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_stream(spark: SparkSession, folder: str, file_filter: str, like: DataFrame) -> DataFrame:
    """A stream of parquet files with the schema of ``like``."""
    return (
        spark.readStream.schema(like.schema).option("pathGlobFilter", file_filter).parquet(folder)
    )


def score_available(
    stream: DataFrame, transform: Callable[[DataFrame], DataFrame], target: str, state: str
) -> DataFrame:
    """Score what is there now into ``target`` and return it as a table."""
    query = (
        transform(stream)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.parquet(target)

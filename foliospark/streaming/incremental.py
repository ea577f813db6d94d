"""Documents and events as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def incremental(
    spark: SparkSession, source: str, schema: StructType, transform: Callable[[DataFrame], DataFrame], out: str, state: str,
) -> StreamingQuery:
    """Process the files that are new since the last call, and stop. What was
    read is kept in `state`, so that each file counts once."""
    new = spark.readStream.schema(schema).parquet(source)
    return (
        transform(new).writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        .trigger(availableNow=True).start()
    )


def windowed_counts(events: DataFrame, at: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """keys..., start, n of event-time windows; later events than `late` are
    dropped in a stream, none in a batch."""
    df = events.withWatermark(at, late) if events.isStreaming else events
    return df.groupBy(F.window(at, width), *keys).agg(F.count("*").alias("n")).select(*keys, F.col("window.start").alias("start"), "n")


def sessions(events: DataFrame, at: str, key: str, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """key, start, end, n of sessions: events less than the gap apart."""
    df = events.withWatermark(at, late) if events.isStreaming else events
    out = df.groupBy(F.session_window(at, gap).alias("s"), key).agg(F.count("*").alias("n"))
    return out.select(key, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")

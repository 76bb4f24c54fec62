"""Streams of landed files: append-only bronze, incremental rebuilds, windowed counts with late data."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from gaugework.sources.landing import with_lineage


def ingest_new_files(spark: SparkSession, landing: str, schema: StructType, bronze: str, checkpoint: str) -> StreamingQuery:
    """Append the files that were not seen yet, each exactly once, and stop."""
    files = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
    query = (
        with_lineage(files).writeStream.format("parquet").option("path", bronze).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def rebuild_on_new_files(
    spark: SparkSession, landing: str, schema: StructType, checkpoint: str, keys: list[str], rebuild: Callable[[DataFrame], None]
) -> StreamingQuery:
    """Call rebuild with the distinct keys of each batch of new files; a batch without rows does nothing."""

    def each(batch: DataFrame, _: int) -> None:
        touched = batch.select(*keys).distinct()
        if not touched.isEmpty():
            rebuild(touched)

    query = (
        spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(landing)
        .writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def overwrite_partitions(df: DataFrame, path: str, partition: list[str]) -> None:
    """Replace only the partitions that df has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def windowed(events: DataFrame, time: str, length: str, late: str, keys: list[str], *aggs: Column) -> DataFrame:
    """Tumbling windows with a watermark. Instants without a zone are taken as UTC."""
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    counted = rows.groupBy(F.window(time, length), *keys).agg(*aggs)
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in counted.columns if c != "window"])

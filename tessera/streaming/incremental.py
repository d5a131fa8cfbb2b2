"""Incremental fills with Structured Streaming: new landing files become published partitions, exactly once by date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.lake import Lake, Rule


def fill_available(spark: SparkSession, lake: Lake, name: str, landing: str, schema: str, checkpoint: str, rules: list[Rule] = ()) -> list:
    """Publishes what has landed (Parquet files under ``landing``) since the last call and stops.

    The checkpoint remembers which files were read; each micro-batch goes through the lake's audit and publish, which
    leave existing partitions alone, so a batch that runs again changes nothing. Returns the dates published.
    """
    done: list = []

    def publish(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            done.extend(lake.publish(name, batch, rules))

    stream = spark.readStream.schema(schema).parquet(landing)
    query = stream.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return sorted(done)

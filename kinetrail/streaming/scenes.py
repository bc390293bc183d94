"""New scene files as a stream. A scene file is complete, so each micro-batch is matched on its own and no state is kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.scenes import SCENE_SCHEMA, write_results


def scene_stream(spark: SparkSession, path: str, files: int = 64) -> DataFrame:
    return spark.readStream.schema(SCENE_SCHEMA).option("maxFilesPerTrigger", files).parquet(path)


def match_stream(scenes: DataFrame, match: Callable[[DataFrame], DataFrame], out: str, checkpoint: str):
    """Starts a query that matches each batch of new scenes and appends its hits."""
    return scenes.writeStream.foreachBatch(lambda df, _: write_results(match(df), out)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

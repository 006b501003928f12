"""Incremental ingest: a stream of review files, deduplicated within a watermark, appended once for each key."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def reviews_stream(spark: SparkSession, path: str, schema: str | StructType, lateness: str = "10 minutes", files: int = 100) -> DataFrame:
    """New files of JSON lines; a review_id seen within the watermark is dropped."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)
    return rows.where("review_id is not null").withWatermark("timestamp", lateness).dropDuplicatesWithinWatermark(["review_id"])


def append_new(stream: DataFrame, target: str, checkpoint: str, days: int = 1) -> StreamingQuery:
    """Append the reviews that target lacks; a batch that runs again, or ran in part, adds only what is missing.

    target is partitioned by the day of the timestamp; of it only the days of the batch, and `days` before and after,
    are read: within those a review_id is appended once.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch = batch.withColumn("day", F.to_date("timestamp")).persist()  # the plan before it has state: evaluate it once
        try:
            span = batch.agg(F.date_sub(F.min("day"), days).alias("lo"), F.date_add(F.max("day"), days).alias("hi")).first()
            if span["lo"] is None:
                return
            new = batch
            try:
                held = batch.sparkSession.read.schema(batch.schema).parquet(target)
                new = batch.join(held.where(F.col("day").between(span["lo"], span["hi"])).select("review_id"), "review_id", "left_anti")
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
            new.write.partitionBy("day").mode("append").parquet(target)
        finally:
            batch.unpersist()

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""The polling loop as a stream: new sheet rows are scored and upserted into a results table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def poll(spark: SparkSession, source: str, schema: str, results: str, checkpoint: str, score: Callable[[DataFrame], DataFrame], every: str | None = None) -> StreamingQuery:
    """Scores rows of parquet files that arrive in `source` and writes one part of `results` for each micro-batch.

    A batch's part is overwritten if the batch runs again after a failure, so results hold each row once. Rows whose id
    has a result already are left out by an anti join. every: a processing interval; without it, what is there is
    processed and the stream ends. Of rows with one id in a batch, one is scored.
    """

    def write(batch: DataFrame, number: int) -> None:
        path = spark._jvm.org.apache.hadoop.fs.Path(results)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        rows = batch.dropDuplicates(["audio_id"])
        if fs.exists(path):
            done = spark.read.option("basePath", results).parquet(results).filter(f"batch <> {number}").select("audio_id")
            rows = rows.join(done, "audio_id", "left_anti")
        score(rows).write.mode("overwrite").parquet(f"{results}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (stream.trigger(processingTime=every) if every else stream.trigger(availableNow=True)).start()

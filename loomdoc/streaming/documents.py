"""Documents as they arrive: every stage works on one document at a time, so a micro-batch is a small table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def arriving(spark: SparkSession, path: str, schema: str = DOCUMENTS, files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def apply(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Writes stage(batch) of every micro-batch to its own folder under out, so a batch that is
    repeated after a failure replaces its first attempt."""

    def write(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()

"""Loading as a stream of files: each file once, quarantine and staging together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import normalize as N


def load_stream(spark: SparkSession, path: str, dataset: str, checkpoint: str, take: Callable[[DataFrame, DataFrame, int], None], files_a_batch: int = 64) -> StreamingQuery:
    """Reads new files below path and gives each batch's valid rows, the others as quarantine records, and its number to take.

    The stream's checkpoint remembers the files, so a restart goes on where it
    stopped; a batch that was cut off is given again with the same number.
    """
    lines = spark.readStream.option("lineSep", "\n").option("maxFilesPerTrigger", files_a_batch).text(path)
    lines = lines.select(F.col("_metadata.file_path").alias("file_path"), F.regexp_replace(F.make_valid_utf8("value"), "\r$", "").alias("value"))

    def batch(rows: DataFrame, number: int) -> None:
        typed = N.dataset_rows(rows, dataset).persist(StorageLevel.DISK_ONLY)  # also keeps the rows in their partitions
        try:
            take(N.valid(typed).drop("value", "file_path"), N.quarantined(typed, dataset, F.col("file_path"), F.lit(None), offset=F.lit(None)), number)
        finally:
            typed.unpersist()

    return lines.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

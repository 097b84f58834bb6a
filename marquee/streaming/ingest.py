"""Continuous ingest: new files in a landing folder -> clean -> keyed merge -> watermark.

Structured Streaming watches the folder and gives each micro-batch its new files (paths only; contents are not read by the
stream). The batch reads them with the table's own reader, columns by header name, and merges them into a table of growing hash
buckets (``operators.buckets``): only the buckets that a batch touches or splits are opened, ids and watermarks come from the
manifest, and the manifest written last commits the batch.
"""
from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from marquee.operators import buckets as bk
from marquee.operators import merge
from marquee.operators.buckets import BUCKET_ROWS, BUCKETS, current_table, current_watermark, latest_version, vacuum, version_path
from marquee.sources.files import CONFLICT_KEYS, TABLE_READERS, read_located

__all__ = ["current_table", "current_watermark", "latest_version", "merge", "merge_files", "stream_ingest", "vacuum", "version_path"]


def merge_files(spark: SparkSession, paths: list[str], table: str, table_path: str, batch_id: int, mode: str = "upsert",
                stamp: datetime | None = None, buckets: int = BUCKETS, keep_versions: int = 3, bucket_rows: int = BUCKET_ROWS) -> dict:
    """Merge files into the table as batch ``batch_id``; does nothing if that batch is committed."""
    if bk.committed(spark, version_path(bk.beside(table_path, "manifest"), batch_id)):
        return {}
    rows = read_located(TABLE_READERS[table], spark, sorted(paths))
    return bk.merge_rows(spark, rows, CONFLICT_KEYS[table], table_path, batch_id, mode, stamp, table, buckets, bucket_rows, keep_versions)


def stream_ingest(spark: SparkSession, landing: str, table_path: str, checkpoint: str, table: str = "ratings",
                  mode: str = "upsert", available_now: bool = True, max_files_per_trigger: int | None = None,
                  poll: str = "60 seconds", clock: Callable[[int], datetime] | None = None, pattern: str = "*.csv",
                  buckets: int = BUCKETS, bucket_rows: int = BUCKET_ROWS):
    """Start the ingest stream of one table (ratings, movies, tags, links or genome_scores); returns the StreamingQuery.

    Rows carry the time of the batch that commits them (``clock`` may replace the wall clock, by batch id)."""
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
    files = files.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        files = files.option("maxFilesPerTrigger", max_files_per_trigger)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.collect()]  # names of new files
        if paths:
            stamp = clock(batch_id) if clock else datetime.now(timezone.utc).replace(tzinfo=None)
            merge_files(batch.sparkSession, paths, table, table_path, batch_id, mode, stamp, buckets, bucket_rows=bucket_rows)

    w = files.load(landing).select("path").writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=poll)
    return w.start()

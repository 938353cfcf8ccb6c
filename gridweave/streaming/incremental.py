"""Arriving documents: a file stream whose batches are resolved and appended, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridweave.plans import resolve
from gridweave.sources import documents, sinks


def stream_texts(spark: SparkSession, root: str, pattern: str = "*_extraction.json", per_batch: int = 1000) -> DataFrame:
    """file, text of new files below a folder, at most per_batch at a time."""
    reader = spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", per_batch)
    return reader.load(root).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def resolve_arriving(spark: SparkSession, root: str, out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Resolve every new file once; each batch replaces its own folder below out, so a repeated batch does no harm."""

    def handle(batch: DataFrame, number: int) -> None:
        keyed = batch.withColumn("protocol_id", documents.protocol_of(F.col("file")))
        docs = documents.parse_extractions(keyed, "text", ["protocol_id", "file"]).where("not is_broken")
        docs = docs.select("protocol_id", F.col("doc.table_metadata.table_number").alias("table_number"), "file", "doc").persist()
        sinks.write_tables(resolve.resolve(docs).all(), f"{out}/batch={number}")
        docs.unpersist()

    writer = stream_texts(spark, root).writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def event_windows(events: DataFrame, at: str, key: str, value: str, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums by key and time window of an event stream; rows later than the watermark are dropped by it."""
    timed = events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", late)
    w = timed.groupBy(F.window("_at", width), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    return w.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), key, "n", "total")

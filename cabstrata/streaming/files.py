"""New raw files as a stream, through the same append path as a batch load."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cabstrata.sources.bronze import SOURCE
from cabstrata.sources.tables import Lake


def stream_files(spark: SparkSession, folder: str, files_per_batch: int = 16) -> DataFrame:
    """The rows of files as they arrive, in the table's types; every file must be readable under them."""
    schema = ", ".join(f"`{c}` {t}" for c, t in SOURCE)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder).select("*", F.col("_metadata.file_name").alias("_source_filename"))


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that Spark gave the stream of this checkpoint; a new or lost checkpoint has another."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/metadata")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    s = fs.open(p)
    try:
        return json.loads(bytes(s.readAllBytes()).decode())["id"]
    finally:
        s.close()


def append_available(spark: SparkSession, lake: Lake, schema: str, table: str, folder: str, checkpoint: str, loaded_by: str = "stream") -> int:
    """Appends every file that this checkpoint hasn't seen yet, then stops; returns the number of batches.

    A batch is known by its stream's id (of the checkpoint) and its number: one that is run again after a
    failure is written once, and streams of other folders or checkpoints never pass for it. A lost
    checkpoint reads its folder again from the start, as a new stream."""
    done = []

    def write(df: DataFrame, epoch: int) -> None:
        stream = f"stream-{checkpoint_id(spark, checkpoint)}"
        rows = df.select("*", F.lit(f"{stream}-{epoch:09d}").alias("_ingest_batch_id"), F.lit(loaded_by).alias("_loaded_by"), F.current_timestamp().alias("_loaded_at"))
        if lake.append_once(schema, table, rows, stream, epoch):
            done.append(epoch)

    q = stream_files(spark, folder).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return len(done)


def hourly_counts(stream: DataFrame, late: str = "2 hours") -> DataFrame:
    """Trips and money per hour and zone of a stream of rows; rows later than `late` are let go."""
    t = stream.withColumn("ts", F.col("tpep_pickup_datetime").cast("timestamp")).withWatermark("ts", late)
    return t.groupBy(F.window("ts", "1 hour"), "PULocationID").agg(F.count(F.lit(1)).alias("trip_count"), F.sum("total_amount").alias("gross_revenue"))

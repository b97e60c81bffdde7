"""Release manifests arrive periodically: a Structured Streaming query over a
manifest drop folder plans every new manifest file with the AWS copy plan
(C1) in ``foreachBatch``.

Each micro-batch is written to its own ``epoch`` partition with dynamic
partition overwrite, so a batch replayed after a failure replaces its own
output (exactly-once output per epoch).  The progress is kept in the
checkpoint location, which must be a shared folder on a cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from objsync.config import PlanConfig
from objsync.operators.relational import last_wins, with_line_no
from objsync.plans import aws
from objsync.sources.readers import strict_long

MANIFEST_STREAM_SCHEMA = ("id string, file_name string, md5 string, size string, state string, project_id string, "
                          "baseid string, version string, release string, acl string, type string, "
                          "deletereason string, url string")


def plan_batch(batch: DataFrame, epoch_id: int, project_map: DataFrame, buckets: DataFrame, inventory: DataFrame,
               source_inventory: DataFrame, cfg: PlanConfig) -> DataFrame:
    """The plan of one micro-batch: rows numbered in file order within the
    batch (W1), then C1."""
    df = batch.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in batch.columns if c not in ("_fp", "_fb")], "_fp", "_fb")
    df = with_line_no(df, block_cols=["_fp", "_fb"]).drop("_fb").withColumnRenamed("_fp", "manifest_file")
    df = df.withColumn("size", strict_long("size"))
    return aws.copy_plan(df, project_map, buckets, inventory, source_inventory, cfg) \
        .withColumn("epoch", F.lit(epoch_id).cast("bigint"))


def _manifest_rows(spark: SparkSession, manifest_dir: str) -> DataFrame:
    """The folder's rows as a stream, with file, split and modification time."""
    return (spark.readStream.schema(MANIFEST_STREAM_SCHEMA).option("header", True).option("sep", "\t")
            .option("quote", '"').option("escape", '"').option("mode", "FAILFAST").option("enforceSchema", False)
            .csv(manifest_dir).select("*", F.col("_metadata.file_path").alias("_fp"),
                                       F.col("_metadata.file_block_start").alias("_fb"),
                                       F.col("_metadata.file_modification_time").alias("_mtime")))


def start_manifest_stream(spark: SparkSession, manifest_dir: str, output_path: str, checkpoint: str,
                          project_map: DataFrame, buckets: DataFrame, inventory: DataFrame,
                          source_inventory: DataFrame, cfg: PlanConfig | None = None,
                          available_now: bool = True) -> StreamingQuery:
    """Start the stream; a file whose header is not that of
    ``MANIFEST_STREAM_SCHEMA`` in that order, or whose size is no integer, fails it.  ``available_now`` processes what is in the folder
    and stops (a periodic job), otherwise it keeps polling."""
    cfg = cfg or PlanConfig()
    stream = _manifest_rows(spark, manifest_dir).drop("_mtime")

    def each(batch: DataFrame, epoch_id: int) -> None:
        plan = plan_batch(batch, epoch_id, project_map, buckets, inventory, source_inventory, cfg)
        (plan.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("epoch").parquet(output_path))

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def start_latest_stream(spark: SparkSession, manifest_dir: str, output_path: str, checkpoint: str,
                        project_map: DataFrame, buckets: DataFrame, inventory: DataFrame,
                        source_inventory: DataFrame, cfg: PlanConfig | None = None,
                        available_now: bool = True) -> StreamingQuery:
    """Like ``start_manifest_stream``, with the last delivered row of every
    ``id`` kept in the stream's state (A9 across epochs): a file delivered twice changes nothing, a
    file that corrects earlier rows replaces their plan.

    Rows are ordered by their file's modification time, its path and their split; a stream knows no
    row positions, so of an id's rows in one split the one of the greatest values counts (a
    release lists an id once).  Of each epoch's changed ids, ``rows`` gets the rows and ``plan`` their plan; ``latest_plan`` is what
    a batch over the last rows of all files would give.  The state is an aggregate with map-side
    combination, so an id in many rows costs one row per task.
    """
    cfg = cfg or PlanConfig()
    stream = _manifest_rows(spark, manifest_dir)
    place = ["_mtime", "_fp", "_fb"]
    rest = [c for c in stream.columns if c not in ("id", *place)]
    latest = stream.groupBy("id").agg(F.max(F.struct(*place, *rest)).alias("r"))

    def each(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select("id", *[F.coalesce(f"r.{c}", F.lit("")).alias(c) for c in rest])
        where = f"{output_path}/rows/epoch={epoch_id}"
        rows.write.mode("overwrite").parquet(where)
        rows = spark.read.schema(rows.schema).parquet(where)
        numbered = with_line_no(rows.select("*", "_metadata.file_path", "_metadata.row_index"), block_cols=["file_path"], pos_col="row_index")
        numbered = numbered.drop("file_path", "row_index").withColumn("size", strict_long("size"))
        plan = aws.copy_plan(numbered, project_map, buckets, inventory, source_inventory, cfg)
        plan.write.mode("overwrite").parquet(f"{output_path}/plan/epoch={epoch_id}")

    writer = latest.writeStream.outputMode("update").foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def latest_plan(spark: SparkSession, output_path: str) -> DataFrame:
    """The plan of the last delivered row of every id (``epoch`` is the one that made it)."""
    plans = spark.read.option("basePath", f"{output_path}/plan").parquet(f"{output_path}/plan")
    return last_wins(plans, ["id"], "epoch")

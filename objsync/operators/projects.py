"""Manifest x project map, and the expected bucket sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.config import PlanConfig
from objsync.functions import routing as R


def attach_projects(manifest: DataFrame, project_map: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Left join the project map on ``project_id``; the planner broadcasts it
    while it is small.

    Adds ``aws_bucket_prefix``, ``gs_bucket_prefix`` and ``known_project``.
    With ``cfg.on_unknown_project == 'fail'`` a row whose project is not in
    the map aborts the job that reads it, as the prepare and validate steps do.
    """
    if cfg.on_unknown_project not in ("reject", "fail"):
        raise ValueError("on_unknown_project must be 'reject' or 'fail'")
    pm = project_map.select("project_id", "aws_bucket_prefix", "gs_bucket_prefix")
    # one entry per project, so the join never multiplies manifest rows
    pm = pm.dropDuplicates(["project_id"]).withColumn("_pm", F.lit(True))
    out = manifest.join(pm, "project_id", "left").withColumn("known_project", F.col("_pm").isNotNull())
    if cfg.on_unknown_project == "fail":
        missing = F.concat(F.lit("project map has no key "), F.coalesce("project_id", F.lit("<null>")))
        out = out.filter(F.when(F.col("_pm").isNotNull(), F.lit(True)).otherwise(F.raise_error(missing).cast("boolean")))
    return out.drop("_pm")


def expected_buckets(project_map: DataFrame) -> DataFrame:
    """Distinct ``(provider, bucket)`` pairs listed for the map (two
    per project and provider)."""
    aws = project_map.select(F.lit("aws").alias("provider"),
                             F.explode(R.aws_expected_buckets("aws_bucket_prefix")).alias("bucket"))
    gs = project_map.select(F.lit("gs").alias("provider"),
                            F.explode(R.gs_expected_buckets("gs_bucket_prefix")).alias("bucket"))
    return aws.unionByName(gs).distinct()

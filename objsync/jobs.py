"""Thin ``(spark, config) -> outputs`` jobs for the five actions: AWS copy
plan (C1), GS copy plan / pipeline (C2, C11), indexing (C13), validation
(C4) and redaction (C5).

``config`` keys name input paths (``manifest``, ``project_map``,
``inventory``, ``source_inventory``, ``buckets``, ``gs_inventory``,
``ignored``, ``index``) and ``output``; inventories/indexes are parquet
tables, or JSON dictionaries when the path ends in ``.json``; an index may
also be a catalog table (``table:<name>``, see ``sinks.write_bucketed_snapshot``).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from objsync import sinks
from objsync.config import PlanConfig
from objsync.operators.inventory import restrict_to_buckets
from objsync.operators.projects import expected_buckets
from objsync.plans import aws, gs, index as I, redaction as RD, validation as V
from objsync.session import release_shuffles
from objsync.sources import readers as S


def _table(spark: SparkSession, path: str) -> DataFrame:
    if path.endswith(".json"):
        return S.read_inventory_json(spark, path)
    return spark.read.parquet(path)


def _index(spark: SparkSession, path: str) -> DataFrame:
    if path.startswith("table:"):
        return spark.table(path[6:])
    if path.endswith(".json"):
        return S.read_index_json(spark, path)
    return S.read_index(spark, path)


def _buckets(spark: SparkSession, config: dict, project_map: DataFrame) -> DataFrame:
    if config.get("buckets"):
        return spark.read.parquet(config["buckets"]).select("bucket")
    return expected_buckets(project_map).select("bucket")


def _need_ignored(ignored: DataFrame) -> None:
    """The jobs stop without structured objects; asked anew in every run."""
    if ignored.isEmpty():
        raise ValueError("expecting a non-empty ignored-objects table")


def _out(config: dict, name: str) -> str:
    return os.path.join(config["output"], name)


def aws_copy_job(spark: SparkSession, config: dict, cfg: PlanConfig | None = None) -> dict:
    """C12 + C1 + A2 + A3 + C6: plan every manifest row and write the plan (its
    counters are taken as it is written), the rows still to copy, the dry-run summary and, where ``index`` is given, the index
    with the handled files' URLs merged in."""
    cfg = cfg or PlanConfig()
    manifest = S.read_manifest(spark, config["manifest"], start=config.get("start"), end=config.get("end"))
    pm = S.read_project_map(spark, config["project_map"])
    plan = aws.copy_plan(manifest, pm, _buckets(spark, config, pm), _table(spark, config["inventory"]),
                         _table(spark, config["source_inventory"]), cfg, resolve_sources="needed")
    counters = Observation("copy_counters")
    plan.observe(counters, *aws.counter_metrics()).write.mode("overwrite").parquet(_out(config, "copy_plan"))
    plan = spark.read.parquet(_out(config, "copy_plan"))
    summary = aws.copy_summary(plan)
    sinks.write_tsv(summary, _out(config, "summary"), single_file=True)
    sinks.write_tsv(plan.filter("needs_copy"), _out(config, "to_copy"),
                    fields=["id", "file_name", "size", "md5", "acl", "project_id", "target_bucket", "action"])
    out = {"plan": plan, "summary": summary, "counters": counters.get}
    if config.get("index"):
        handled = plan.filter(F.col("action").isin("MOVE", "COPY", "ALREADY_COPIED") | F.col("in_summary"))
        url = F.concat(F.lit("s3://"), F.col("target_bucket"), F.lit("/"), F.col("object_key"))
        updates = I.index_updates(handled.withColumn("url", url), cfg)
        sinks.write_snapshot(I.merge_index(_index(spark, config["index"]), updates, cfg), _out(config, "index"))
        out["index"] = spark.read.parquet(_out(config, "index"))
    return out


def gs_copy_job(spark: SparkSession, config: dict, cfg: PlanConfig | None = None) -> dict:
    """J3/K2 + C2 + K3/K4 + C6: pipeline manifest of the files not yet listed,
    the copy plan over it, its result lines and log, and, where ``index`` is
    given, the index with the plan's URLs merged in."""
    cfg = cfg or PlanConfig()
    manifest = S.read_manifest(spark, config["manifest"])
    pm = S.read_project_map(spark, config["project_map"])
    gsi = _table(spark, config["gs_inventory"])
    ignored = gs.ignored_objects(S.read_ignored(spark, config["ignored"]), order_col="line_no")
    _need_ignored(ignored)
    pipe = gs.pipeline_manifest(manifest, pm, gsi, cfg)
    sinks.write_pipeline_manifest(pipe, _out(config, "pipeline_manifest"))
    plan = gs.copy_plan(pipe, pm, _buckets(spark, config, pm), gsi, ignored, cfg)
    plan.write.mode("overwrite").parquet(_out(config, "gs_plan"))
    plan = spark.read.parquet(_out(config, "gs_plan"))
    sinks.write_result_lines(gs.result_lines(plan), _out(config, "results"))
    sinks.write_result_log(plan, _out(config, "result_log"), config.get("release", "release"))
    out = {"plan": plan}
    if config.get("index"):
        updates = I.index_updates(plan.filter(F.col("index_url").isNotNull()), cfg, url_col="index_url")
        sinks.write_snapshot(I.merge_index(_index(spark, config["index"]), updates, cfg), _out(config, "index"))
        out["index"] = spark.read.parquet(_out(config, "index"))
    return out


def indexing_job(spark: SparkSession, config: dict, cfg: PlanConfig | None = None) -> dict:
    """C13 + C6: indexing status of every file and the merged index."""
    cfg = cfg or PlanConfig()
    manifest = S.read_manifest(spark, config["manifest"])
    pm = S.read_project_map(spark, config["project_map"])
    inv = _table(spark, config["inventory"])
    I.indexing_status(manifest, pm, inv, cfg).write.mode("overwrite").parquet(_out(config, "indexing_status"))
    status = spark.read.parquet(_out(config, "indexing_status"))
    rows = aws.route_aws(manifest, pm, cfg).join(status.filter("copy_success").select("line_no"), "line_no", "left_semi")
    rows = rows.withColumn("url", F.concat(F.lit("s3://"), F.col("target_bucket"), F.lit("/"), F.col("object_key")))
    merged = I.merge_index(_index(spark, config["index"]), I.index_updates(rows, cfg), cfg)
    sinks.write_snapshot(merged, _out(config, "index"))
    return {"status": status,
            "index": spark.read.parquet(_out(config, "index"))}


def validation_job(spark: SparkSession, config: dict, cfg: PlanConfig | None = None) -> dict:
    """C4: validate one or more manifests in one pass; write the augmented
    manifests (passed, or force) under ``manifest`` and the fail lists under
    ``FAIL_manifest``, a folder ``manifest_no=<i>`` each, and the counters of
    manifests and run.  Returns the run's pass flag (A5), counted while the rows
    are written."""
    cfg = cfg or PlanConfig(platform=config.get("platform", "AWS"), on_unknown_project="fail",
                            force_manifest=bool(config.get("force", False)))
    paths = config["manifests"]
    frames = [S.read_manifest(spark, p).withColumn("manifest_no", F.lit(i)) for i, p in enumerate(paths)]
    manifest = frames[0]
    for f in frames[1:]:
        manifest = manifest.unionByName(f, allowMissingColumns=True)
    pm = S.read_project_map(spark, config["project_map"])
    ignored = gs.ignored_objects(S.read_ignored(spark, config["ignored"]), order_col="line_no")
    _need_ignored(ignored)
    urls = I.index_url_map(_index(spark, config["index"]))
    exp = expected_buckets(pm)
    # the job lists the expected buckets only
    aws_inv = restrict_to_buckets(_table(spark, config["inventory"]), exp.filter(F.col("provider") == "aws"))
    gs_inv = restrict_to_buckets(_table(spark, config["gs_inventory"]), exp.filter(F.col("provider") == "gs"))
    rows = V.validate_rows(manifest, pm, urls, aws_inv, gs_inv, ignored, cfg)
    failures = Observation("run_failures")
    rows.observe(failures, *V.run_failures()).write.mode("overwrite").option("compression", "zstd").parquet(_out(config, "validated"))
    release_shuffles(spark)
    rows = spark.read.parquet(_out(config, "validated"))
    counts = V.validate_counts(rows)
    report = V.run_report(counts, cfg.force_manifest)
    sinks.write_tsv(report, _out(config, "counts"), single_file=True)
    write_validation_reports(rows, counts, config["output"], cfg.force_manifest)
    return {"passed": not any(failures.get.values()), "failures": failures.get, "counts": counts, "report": report}


def write_validation_reports(rows: DataFrame, counts: DataFrame, output: str, force: bool = False) -> None:
    """K1 of a validation run: all augmented manifests in one write, all fail
    lists in another; a manifest without rows for its report has no folder."""
    judged = V.with_verdict(rows, counts, force)
    fields = [c for c in V.C.MANIFEST_COLUMNS if c != "url"] + ["aws_url", "gs_url", "indexd_url"]
    sinks.write_tsv_by(judged.filter(F.col("output") == "manifest"), os.path.join(output, "manifest"),
                       "manifest_no", list(V.C.AUGMENTED_COLUMNS), ["line_no"], report=V.augmented_manifest)
    release_shuffles(rows.sparkSession)
    sinks.write_tsv_by(judged.filter(F.col("output") == "FAIL_manifest"), os.path.join(output, "FAIL_manifest"),
                       "manifest_no", fields, ["line_no", "check_no"], report=V.fail_list)
    release_shuffles(rows.sparkSession)


def redaction_job(spark: SparkSession, config: dict, cfg: PlanConfig | None = None) -> dict:
    """C5 + A6 (+ I2/I3 on a real run): the redaction log, its summary and
    the index after URL removal and record deletion."""
    cfg = cfg or PlanConfig(dry_run=bool(config.get("dry_run", True)),
                            redact_scope=config.get("scope", "all"))
    manifest = S.read_manifest(spark, config["manifest"])
    pm = S.read_project_map(spark, config["project_map"])
    ignored = gs.ignored_objects(S.read_ignored(spark, config["ignored"]), order_col="line_no")
    log = RD.redaction_plan(manifest, pm, _table(spark, config["inventory"]), _table(spark, config["gs_inventory"]),
                            ignored, cfg)
    log.write.mode("overwrite").parquet(_out(config, "redaction_log"))
    log = spark.read.parquet(_out(config, "redaction_log"))
    summary = RD.redaction_summary(log)
    out = {"log": log, "summary": summary}
    if not cfg.dry_run:
        sinks.write_deletion_log(log, _out(config, "deletion_log"), config.get("release", "release"))
        if config.get("index"):
            idx = I.remove_index_urls(_index(spark, config["index"]), RD.index_url_removals(log)).drop("updated")
            idx = I.delete_index_records(idx, RD.index_record_deletes(manifest, pm, cfg))
            sinks.write_snapshot(idx, _out(config, "index"))
            out["index"] = spark.read.parquet(_out(config, "index"))
    return out

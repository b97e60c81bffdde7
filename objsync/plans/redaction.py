"""Redaction plan and log (C5), its summary (A6) and the index edits it
implies (I2 URL removals, I3 record deletes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from objsync import config as C
from objsync.config import PlanConfig
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.operators.inventory import inventory_by_key, listed, normalize_inventory, probe_join
from objsync.operators.projects import attach_projects
from objsync.plans.gs import attach_ignored

LOG_COLUMNS = ["line_no", "id", "provider", *C.DELETION_LOG_FIELDS]
_UPDATED = C.DELETION_LOG_FIELDS[2]


def _scope(cfg: PlanConfig) -> tuple[bool, bool]:
    s = cfg.redact_scope
    if s not in ("all", "s3", "aws", "gs"):
        raise ValueError("redact_scope must be all, s3, aws or gs")
    return s in ("all", "s3", "aws"), s in ("all", "gs")


def redaction_plan(manifest: DataFrame, project_map: DataFrame, aws_inventory: DataFrame, gs_inventory: DataFrame,
                   ignored_objs: DataFrame, cfg: PlanConfig) -> DataFrame:
    """C5 log rows, one per (file, provider) step taken.

    S3 step (scope all/s3): object ``id/(filename or file_name)`` in the
    target bucket; absent -> not deleted, no message; present -> deleted
    (on a real run also the index-updated flag).  GS step only when not a dry
    run (scope all/gs): key is the structured key of an ignored id, else
    ``id/name``; a missing object is a failed delete with a message.
    Unknown projects give one log row per step with a message.
    """
    do_s3, do_gs = _scope(cfg)
    do_gs = do_gs and not cfg.dry_run
    if not (do_s3 or do_gs):
        raise ValueError("nothing to redact for this scope and dry-run setting")
    name = U.object_key("id", F.coalesce(F.nullif(F.col("filename"), F.lit("")), F.col("file_name"))) \
        if "filename" in manifest.columns else U.object_key("id", "file_name")
    m = attach_projects(manifest, project_map, cfg).withColumn("_key", name)
    if do_gs:
        m = attach_ignored(m, ignored_objs)
    steps, listings = [], []
    if do_s3:
        steps.append(_step("s3", R.aws_bucket("aws_bucket_prefix", "acl"), F.col("_key")))
        listings.append(_tagged(aws_inventory, "s3"))
    if do_gs:
        gs_key = F.coalesce(F.when(F.col("is_ignored"), F.col("structured_key")), F.col("_key"))
        steps.append(_step("gs", R.gs_bucket("gs_bucket_prefix", "acl"), gs_key))
        listings.append(_tagged(gs_inventory, "gs"))
    # both steps of a file probe one inventory, whose buckets are told apart by provider
    rows = m.select("line_no", "id", "project_id", "known_project", "_key", F.explode(F.array(*steps)).alias("_s"))
    rows = rows.select("*", "_s.*").drop("_s")
    inventory = listings[0] if len(listings) == 1 else listings[0].unionByName(listings[1])
    rows = probe_join(rows, inventory_by_key(inventory, dedupe=cfg.dedupe_inventory), F.col("_probed"), "_objs", cfg.spread_hot_keys)
    known, on_gs = F.col("known_project"), F.col("provider") == "gs"
    present = known & listed("_objs", F.concat_ws(":", "provider", "_bucket"))
    url = F.concat(F.col("provider"), F.lit("://"), F.col("_bucket"), F.lit("/"), F.col("_probed"))
    return rows.select(
        "line_no", "id", "provider",
        F.when(known, url).otherwise(F.col("_key")).alias("url"),
        present.alias("deleted"),
        (present & (F.lit(not cfg.dry_run) | on_gs)).alias(_UPDATED),
        F.when(~known, F.concat(F.lit("project "), F.coalesce(F.col("project_id"), F.lit("None")), F.lit(" is not in the project map")))
        .when(on_gs & ~present, F.concat(F.lit("No such object: "), F.col("_bucket"), F.lit("/"), F.col("_probed")))
        .alias("message")).select(*LOG_COLUMNS)


def _step(provider: str, bucket: Column, key: Column) -> Column:
    return F.struct(F.lit(provider).alias("provider"), bucket.alias("_bucket"), key.alias("_probed"))


def _tagged(inventory: DataFrame, provider: str) -> DataFrame:
    """A listing whose bucket names say the provider."""
    inv = normalize_inventory(inventory)
    if "seq" not in inv.columns:
        inv = inv.withColumn("seq", F.lit(0).cast("bigint"))
    return inv.withColumn("bucket", F.concat(F.lit(provider + ":"), F.col("bucket")))


def redaction_summary(log: DataFrame) -> DataFrame:
    """Per provider, files deleted (or to delete) and files checked.
    Both providers always appear (GS is 0/0 on a dry run)."""
    counts = log.agg(*[
        agg for p in ("s3", "gs") for agg in (
            F.sum(F.when(F.col("provider") == p, 1).otherwise(0)).cast("bigint").alias(f"{p}_total"),
            F.sum(F.when((F.col("provider") == p) & F.col("deleted"), 1).otherwise(0)).cast("bigint")
            .alias(f"{p}_deleted"))])
    return counts.selectExpr("stack(2, 's3', s3_deleted, s3_total, 'gs', gs_deleted, gs_total) "
                             "as (provider, deleted, total)")


def index_url_removals(log: DataFrame) -> DataFrame:
    """I2 input: ``(did, url)`` for every object actually deleted."""
    return log.filter(F.col(_UPDATED)).select(F.col("id").alias("did"), "url")


def index_record_deletes(manifest: DataFrame, project_map: DataFrame, cfg: PlanConfig) -> DataFrame:
    """I3 input: ids whose record is deleted after the GS step (any known
    project, when the GS step runs; whatever the GS delete outcome)."""
    _, do_gs = _scope(cfg)
    if cfg.dry_run or not do_gs:
        return manifest.select(F.col("id").alias("did")).filter(F.lit(False))
    m = attach_projects(manifest, project_map, cfg)
    return m.filter(F.col("known_project")).select(F.col("id").alias("did")).distinct()

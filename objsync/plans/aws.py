"""AWS side: files still to copy (C12/J2/A1), copy plan (C1) and its dry-run
summary (A3), source-key resolution (J6/J7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync import config as C
from objsync.config import PlanConfig
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.functions.objects import gib
from objsync.operators.inventory import (
    inventory_by_key, listed, listed_size, probe_join, restrict_to_buckets,
)
from objsync.operators.projects import attach_projects, expected_buckets


def route_aws(manifest: DataFrame, project_map: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Manifest rows with ``target_bucket`` (P3) and ``object_key``."""
    m = attach_projects(manifest, project_map, cfg)
    return (m.withColumn("target_bucket", R.aws_bucket("aws_bucket_prefix", "acl"))
             .withColumn("object_key", U.object_key("id", "file_name")))


def aws_inventory_by_key(inventory: DataFrame, project_map: DataFrame, cfg: PlanConfig,
                         restrict: bool = True) -> DataFrame:
    """Inventory of the expected AWS buckets (S7), grouped by key.  The
    bucket filter runs before the last-wins dedupe so only listed buckets
    are shuffled."""
    inv = inventory
    if restrict:
        exp = expected_buckets(project_map).filter(F.col("provider") == "aws")
        inv = restrict_to_buckets(inv, exp)
    return inventory_by_key(inv, dedupe=cfg.dedupe_inventory)


def to_copy(manifest: DataFrame, project_map: DataFrame, inventory: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Rows whose target key is absent from the inventory or listed with a
    different size.  Unknown projects (null bucket) always count."""
    m = route_aws(manifest, project_map, cfg)
    m = probe_join(m, aws_inventory_by_key(inventory, project_map, cfg), F.col("object_key"), spread=cfg.spread_hot_keys)
    keep = ~listed("objects", "target_bucket") | (listed_size("objects", "target_bucket") != F.col("size"))
    return m.filter(keep).drop("objects")


def copy_totals(to_copy_rows: DataFrame) -> DataFrame:
    """A1 per target bucket: files and bytes still to copy."""
    return (to_copy_rows.groupBy("target_bucket")
            .agg(F.count(F.lit(1)).alias("n_files"), F.sum("size").cast("bigint").alias("total_bytes"))
            .withColumn("total_gib", gib("total_bytes")))


def best_source_keys(rows: DataFrame, source_inventory: DataFrame, row_id: str = "line_no") -> DataFrame:
    """J6/J7 core: ``(row_id, source_key, source_priority,
    source_storage_class)`` for the rows that have at least one candidate in
    the source listing.

    Candidates are exploded (at most three per row, nulls dropped so there
    is no null-key hot spot), inner-joined with the source listing on key
    (narrow rows: id, priority, key), and the best priority per row is kept.
    """
    # one row per key, so a repeated key never multiplies candidates: the last
    # listing's entry, or the smallest; a hash-based aggregate whose
    # partitioning on key is the join's, no extra exchange
    src = source_inventory
    if "seq" in src.columns:
        src = src.groupBy("key").agg(F.array_max(F.collect_set(F.struct("seq", "storage_class")))["storage_class"].alias("storage_class"))
    else:
        src = src.groupBy("key").agg(F.array_min(F.collect_set("storage_class")).alias("storage_class"))
    src = src.select(F.col("key").alias("_ck"), F.col("storage_class").alias("_csc"))
    cands = rows.select(
        F.col(row_id),
        F.explode(F.array(
            F.struct(F.lit(1).alias("pri"), U.object_key("id", "file_name").alias("ck")),
            F.struct(F.lit(2).alias("pri"), U.uuid_tail_key("url").alias("ck")),
            F.struct(F.lit(3).alias("pri"), F.col("id").alias("ck")),
        )).alias("c")).select(row_id, F.col("c.pri").alias("_pri"), F.col("c.ck").alias("_ck"))
    cands = cands.filter(F.col("_ck").isNotNull())
    # at most three matches per row (one per candidate, the listing is
    # unique on key): the smallest (priority, ...) struct of the collected
    # list is the best match; a hash-based aggregate, no sort
    best = (cands.join(src, "_ck")
            .groupBy(row_id)
            .agg(F.array_min(F.collect_list(F.struct(F.col("_pri").alias("p"), F.col("_ck").alias("k"),
                                                     F.col("_csc").alias("s")))).alias("_best")))
    return best.select(row_id, F.col("_best.k").alias("source_key"), F.col("_best.p").alias("source_priority"),
                       F.col("_best.s").alias("source_storage_class"))


def resolve_source_keys(rows: DataFrame, source_inventory: DataFrame, row_id: str = "line_no") -> DataFrame:
    """``rows`` with ``source_key``, ``source_priority`` and
    ``source_storage_class`` (nulls when no candidate exists): the first
    existing key among ``id/file_name`` (1), the UUID tail of ``url`` (2)
    and ``id`` (3)."""
    return rows.join(best_source_keys(rows, source_inventory, row_id), row_id, "left")


PLAN_COLUMNS = [
    "line_no", "id", "file_name", "size", "md5", "acl", "project_id", "target_bucket", "object_key",
    "source_key", "source_priority", "storage_class", "action", "copy_method", "in_summary",
    "needs_copy", "reject_reason",
]


def copy_plan(manifest: DataFrame, project_map: DataFrame, buckets: DataFrame, inventory: DataFrame,
              source_inventory: DataFrame, cfg: PlanConfig, resolve_sources: str = "all") -> DataFrame:
    """Per manifest row, the first matching action:

    1. project not in the map -> ``REJECT`` (``unknown_project``)
    2. target bucket does not exist -> ``REJECT`` (``no_bucket``)
    3. key listed in the opposite-ACL bucket -> ``MOVE`` (AWS)
    4. key not listed in the target bucket: no source key -> ``STREAM``
       (API, not in the dry-run summary); cold storage -> ``STREAM`` (API);
       else ``COPY`` (AWS, source storage class)
    5. otherwise ``ALREADY_COPIED`` (a different size does not re-copy)

    ``needs_copy`` is J2 (absent or size differs), the prepare filter.

    ``resolve_sources="all"`` (lazy, one pass): every row looks for a source key,
    independently of the probe.  ``"needed"`` (the copy job's mode): the probe-joined rows are
    materialized by a reliable ``checkpoint`` (the session's checkpoint folder) first, and only
    rows still pending a copy look for a source key.  ``"pending"``: the same without a
    checkpoint, for plans that must stay lazy; the probe is then planned twice, and
    whatever of it Spark does not reuse is shuffled twice.
    """
    if resolve_sources not in ("pending", "all", "needed"):
        raise ValueError("resolve_sources must be 'pending', 'all' or 'needed'")
    m = route_aws(manifest, project_map, cfg)
    bl = buckets.select("bucket").distinct().withColumn("_bx", F.lit(True))
    m = (m.join(bl, m["target_bucket"] == bl["bucket"], "left").drop("bucket")
          .withColumn("bucket_exists", F.coalesce(F.col("_bx"), F.lit(False))).drop("_bx"))
    m = probe_join(m, aws_inventory_by_key(inventory, project_map, cfg), F.col("object_key"), spread=cfg.spread_hot_keys)
    present = listed("objects", "target_bucket")
    moved = listed("objects", R.aws_reversed_bucket("target_bucket"))
    pending = F.col("known_project") & F.col("bucket_exists") & ~moved & ~present
    asking = ["line_no", "id", "file_name", "url"]
    if resolve_sources == "needed":
        from objsync.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(m.sparkSession)
        m = m.withColumn("_pending", pending).checkpoint(eager=True)
        src_rows = m.filter(F.col("_pending")).select(*asking)
        m = m.drop("_pending")
    else:
        src_rows = m.filter(pending).select(*asking) if resolve_sources == "pending" else manifest.select(*asking)
    best = best_source_keys(src_rows, source_inventory)
    m = m.join(best, "line_no", "left")
    found = F.col("source_key").isNotNull()
    sc = F.coalesce(F.col("source_storage_class"), F.lit(C.DEFAULT_STORAGE_CLASS))
    stream = ~found | sc.isin(*C.COLD_STORAGE_CLASSES)
    action = (F.when(~F.col("known_project") | ~F.col("bucket_exists"), F.lit("REJECT"))
              .when(moved, F.lit("MOVE"))
              .when(present, F.lit("ALREADY_COPIED"))
              .when(stream, F.lit("STREAM"))
              .otherwise(F.lit("COPY")))
    sourced = F.col("action").isin("STREAM", "COPY")
    return m.withColumn("action", action).select(
        "line_no", "id", "file_name", "size", "md5", "acl", "project_id", "target_bucket", "object_key",
        F.when(sourced, F.col("source_key")).alias("source_key"),
        F.when(sourced, F.col("source_priority")).alias("source_priority"),
        F.when(sourced & found, sc).alias("storage_class"),
        "action",
        F.when(F.col("action").isin("MOVE", "COPY"), F.lit(C.SERVER_METHOD))
        .when(F.col("action") == "STREAM", F.lit(C.STREAM_METHOD)).alias("copy_method"),
        (F.col("action").isin("MOVE", "COPY") | ((F.col("action") == "STREAM") & found)).alias("in_summary"),
        (~present | (listed_size("objects", "target_bucket") != F.col("size"))).alias("needs_copy"),
        F.when(~F.col("known_project"), F.lit("unknown_project"))
        .when(~F.col("bucket_exists"), F.lit("no_bucket")).alias("reject_reason"))


def counter_metrics() -> list:
    """A2 as metrics over plan rows, for ``agg`` or for ``DataFrame.observe`` on
    the plan's own write: files processed, their bytes, and all files.  Rows that return early
    (rejected, or streamed without a source key) are not counted; already-copied rows are."""
    counted = F.col("action").isin("MOVE", "COPY", "ALREADY_COPIED") | \
        ((F.col("action") == "STREAM") & F.col("in_summary"))
    return [F.sum(F.when(counted, 1).otherwise(0)).cast("bigint").alias("processed_files"),
            F.sum(F.when(counted, F.col("size")).otherwise(0)).cast("bigint").alias("processed_bytes"),
            F.count(F.lit(1)).alias("total_files")]


def copy_counters(plan: DataFrame) -> DataFrame:
    """A2: the job's progress counters after a run: files processed and
    their GiB.  One global two-phase aggregate."""
    return plan.agg(*counter_metrics()).withColumn("processed_gib", gib("processed_bytes"))


SUMMARY_CATEGORIES = (C.STREAM_METHOD, "AWS_INTELLIGENT_TIERING", "AWS_OTHER", "STREAM_NOT_COUNTED")


def copy_summary(plan: DataFrame) -> DataFrame:
    """A3: dry-run summary, one row per category.

    The first three are the job's printed counters (rows of the summary:
    MOVE, COPY and cold-storage STREAM).  ``STREAM_NOT_COUNTED`` reports the
    streamed rows without a source key, which the job leaves out of its
    counters.  A global two-phase aggregate: partial sums map-side, one row
    per task shuffled.
    """
    api = F.col("copy_method") == C.STREAM_METHOD
    it = F.coalesce(F.col("storage_class") == C.INTELLIGENT_TIERING, F.lit(False))
    cat = (F.when(~F.col("in_summary"), F.when(api, F.lit("STREAM_NOT_COUNTED")))
           .when(api, F.lit(C.STREAM_METHOD))
           .when(it, F.lit("AWS_INTELLIGENT_TIERING"))
           .otherwise(F.lit("AWS_OTHER")))
    aggs = []
    for i, name in enumerate(SUMMARY_CATEGORIES):
        hit = F.coalesce(cat == name, F.lit(False))
        aggs.append(F.sum(F.when(hit, 1).otherwise(0)).cast("bigint").alias(f"n{i}"))
        aggs.append(F.sum(F.when(hit, F.col("size")).otherwise(0)).cast("bigint").alias(f"b{i}"))
    one = plan.agg(*aggs)
    stack = ", ".join(f"'{n}', n{i}, b{i}" for i, n in enumerate(SUMMARY_CATEGORIES))
    return (one.selectExpr(f"stack({len(SUMMARY_CATEGORIES)}, {stack}) as (category, n_files, total_bytes)")
            .withColumn("total_gib", gib("total_bytes")))

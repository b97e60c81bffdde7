"""GS side: ignored (structured) objects (S5/P11), pipeline manifest (J3/K2),
copy plan (C2/C3) and result lines (K3/K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync import config as C
from objsync.config import PlanConfig
from objsync.functions import acl as A
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.functions.objects import py_bool_text, py_text
from objsync.operators.inventory import inventory_by_key, listed, probe_join, restrict_to_buckets
from objsync.operators.projects import attach_projects, expected_buckets
from objsync.operators.relational import last_wins


def ignored_objects(ignored: DataFrame, order_col: str | None = None) -> DataFrame:
    """Structured objects on the fixed host, unique on uuid (last row
    wins when ``order_col`` gives the file order), with ``structured_key``
    (P11).  Columns: ``gdc_uuid, gcs_object_url, gcs_object_size, structured_key``."""
    ig = ignored.filter(U.url_netloc("gcs_object_url") == F.lit(C.IGNORED_HOST))
    ig = ig.select("gdc_uuid", "gcs_object_url", F.col("gcs_object_size").cast("bigint").alias("gcs_object_size"),
                   *([order_col] if order_col else []))
    if order_col:
        ig = last_wins(ig, ["gdc_uuid"], order_col).drop(order_col)
    else:
        ig = ig.dropDuplicates(["gdc_uuid"])
    return ig.withColumn("structured_key", U.structured_key("gcs_object_url"))


def attach_ignored(manifest: DataFrame, ignored_objs: DataFrame, *more: str) -> DataFrame:
    """``is_ignored`` and ``structured_key`` (and the columns ``more``) per manifest row.  A plain
    left join: AQE turns it into a broadcast when the runtime size is small."""
    ig = ignored_objs.select(F.col("gdc_uuid").alias("_ig_id"), "structured_key", *more).withColumn("_ig", F.lit(True))
    return (manifest.join(ig, manifest["id"] == ig["_ig_id"], "left").drop("_ig_id")
            .withColumn("is_ignored", F.coalesce(F.col("_ig"), F.lit(False))).drop("_ig"))


def gs_inventory_by_key(gs_inventory: DataFrame, project_map: DataFrame | None, cfg: PlanConfig) -> DataFrame:
    inv = gs_inventory
    if project_map is not None:
        exp = expected_buckets(project_map).filter(F.col("provider") == "gs")
        inv = restrict_to_buckets(inv, exp)
    return inventory_by_key(inv, dedupe=cfg.dedupe_inventory)


def pipeline_manifest(manifest: DataFrame, project_map: DataFrame, gs_inventory: DataFrame,
                      cfg: PlanConfig) -> DataFrame:
    """J3 + K2: rows whose ``gs_bucket/id/file_name`` (raw name) is not
    listed, projected to the 6-column pipeline manifest with ``_`` for
    spaces in names and spaces removed from ACLs.  Rows of unknown projects
    are kept (the copy step rejects them).

    The job lists the expected GS buckets only (S8), but every probed bucket
    (P4) is one of them, so the listing filter cannot change the result and
    is left out: the inventory subtree is then the same as the copy plan's
    and its exchange is shared when both run in one plan."""
    m = attach_projects(manifest, project_map, cfg).withColumn("gs_bucket", R.gs_bucket("gs_bucket_prefix", "acl"))
    m = probe_join(m, gs_inventory_by_key(gs_inventory, None, cfg), U.object_key("id", "file_name"))
    m = m.filter(~listed("objects", "gs_bucket"))
    return m.select("line_no", "id", U.safe_name("file_name").alias("file_name"), "size", "md5",
                    U.compact_acl("acl").alias("acl"), "project_id")


GS_PLAN_COLUMNS = [
    "line_no", "id", "file_name", "size", "md5", "acl", "project_id", "gs_bucket", "blob_name", "action",
    "reject_reason", "copy_success", "index_success", "message", "index_url",
]


def copy_plan(manifest: DataFrame, project_map: DataFrame, buckets: DataFrame, gs_inventory: DataFrame,
              ignored_objs: DataFrame, cfg: PlanConfig) -> DataFrame:
    """Per row, first match: empty file -> ``SKIP_EMPTY``; unknown project
    or missing bucket -> ``REJECT``; ignored id -> ``INDEX_ONLY`` (C3: the
    structured object's URL is indexed when listed); null ACL -> ``ERROR``;
    key in the opposite-ACL bucket -> ``MOVE``; listed -> ``ALREADY_COPIED``;
    else ``STREAM``.  ``copy_success``/``index_success``/``message`` are the
    job's result row assuming every copy succeeds; an invalid ACL fails the
    index update with an internal error.  ``index_url`` is the URL handed to
    the index merge (null when nothing is indexed)."""
    m = attach_projects(manifest, project_map, cfg)
    bl = buckets.select("bucket").distinct().withColumn("_bx", F.lit(True))
    m = m.withColumn("gs_bucket", R.gs_bucket("gs_bucket_prefix", "acl"))
    m = (m.join(bl, m["gs_bucket"] == bl["bucket"], "left").drop("bucket")
          .withColumn("bucket_exists", F.coalesce(F.col("_bx"), F.lit(False))).drop("_bx"))
    m = attach_ignored(m, ignored_objs)
    m = m.withColumn("blob_name", U.object_key("id", "file_name"))
    probe = F.when(F.col("is_ignored"), F.col("structured_key")).otherwise(F.col("blob_name"))
    m = probe_join(m, gs_inventory_by_key(gs_inventory, None, cfg), probe)
    rev = R.gs_reversed_bucket("gs_bucket", "acl")
    valid = A.acl_valid("acl")
    internal = F.concat(F.lit("Internal error. Detail "), A.bad_acl_message("acl"))
    ig_listed = F.col("is_ignored") & listed("objects", "gs_bucket")
    action = (F.when(F.col("size") == 0, F.lit("SKIP_EMPTY"))
              .when(~F.col("known_project") | ~F.col("bucket_exists"), F.lit("REJECT"))
              .when(F.col("is_ignored"), F.lit("INDEX_ONLY"))
              .when(F.col("acl").isNull(), F.lit("ERROR"))
              .when(listed("objects", rev), F.lit("MOVE"))
              .when(listed("objects", "gs_bucket"), F.lit("ALREADY_COPIED"))
              .otherwise(F.lit("STREAM")))
    m = m.withColumn("action", action)
    a = F.col("action")
    copying = a.isin("MOVE", "ALREADY_COPIED", "STREAM")
    ok = copying & valid
    message = (F.when(a == "SKIP_EMPTY", F.concat(F.lit("can not copy "), F.col("id"),
                                                 F.lit(" to GOOGLE bucket since it is empty file")))
               .when(~F.col("known_project"), F.concat(F.lit("can not copy "), F.col("id"),
                                                      F.lit(" to GOOGLE bucket. Detail project "),
                                                      py_text(F.col("project_id")),
                                                      F.lit(" is not in the project map")))
               .when(a == "REJECT", F.concat(F.lit("There is no bucket with provided name "), F.col("gs_bucket"),
                                             F.lit("\n")))
               .when((a == "INDEX_ONLY") & ig_listed & ~valid, internal)
               .when(a == "INDEX_ONLY", F.concat(F.col("id"), F.lit(" is in the ignored list")))
               .when(a == "ERROR", F.lit("Internal error. Detail acl is missing"))
               .when(~valid, internal)
               .otherwise(F.concat(F.lit("object "), F.col("blob_name"), F.lit(" successfully copied "))))
    index_url = (F.when((a == "INDEX_ONLY") & ig_listed & valid,
                        U.provider_url("gs", "gs_bucket", "structured_key"))
                 .when(ok, U.provider_url("gs", "gs_bucket", "blob_name")))
    return (m.withColumn("reject_reason", F.when(a == "REJECT", F.when(~F.col("known_project"),
                                                                      F.lit("unknown_project"))
                                                 .otherwise(F.lit("no_bucket"))))
             .withColumn("copy_success", ok)
             .withColumn("index_success", ok)
             .withColumn("message", message)
             .withColumn("index_url", index_url)
             .select(*GS_PLAN_COLUMNS))


def result_lines(plan: DataFrame, safe_names: bool = False) -> DataFrame:
    """K3 (``safe_names=False``) / K4 (``True``): the 9 tab-separated fields
    of a result row; null prints as ``None`` and booleans as ``True/False``."""
    name = U.safe_name("file_name") if safe_names else F.col("file_name")
    line = F.concat_ws("\t", py_text(F.col("id")), py_text(name), F.col("size").cast("string"),
                       py_text(F.col("md5")), py_text(F.col("acl")), py_text(F.col("project_id")),
                       py_bool_text(F.col("copy_success")), py_bool_text(F.col("index_success")),
                       py_text(F.col("message")))
    return plan.select("line_no", "id", line.alias("line"))

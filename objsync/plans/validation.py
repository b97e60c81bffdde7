"""Validation of released manifests against inventories and the index
(C4), its counters (A4/A5), fail list (U3) and augmented manifest (P30)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from objsync import config as C
from objsync.config import PlanConfig
from objsync.functions import acl as A
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.operators.inventory import inventory_by_key, listed, probe_join
from objsync.operators.projects import attach_projects
from objsync.plans.gs import attach_ignored


def _aws(platform: str) -> bool:
    return platform in ("AWS", "ALL")


def _gs(platform: str) -> bool:
    return platform in ("GS", "ALL")


def _path(provider: str, bucket, key) -> Column:
    """A listed object's place, provider and bucket included."""
    return F.concat(F.lit(provider + "/"), bucket, F.lit("/"), key)


def _listing(inv: DataFrame, provider: str) -> DataFrame:
    """A listing whose entries are found by their key with ``_`` for blanks (P10) and named by
    their whole path.  Whether an object is listed does not depend on its last listing."""
    bucket, key = F.col("bucket").cast("string"), F.col("key").cast("string")
    return inv.select(_path(provider, bucket, key).alias("bucket"), U.safe_name(key).alias("key"), F.lit(0).alias("size"))


def validate_rows(manifest: DataFrame, project_map: DataFrame, index_urls: DataFrame, aws_inventory: DataFrame,
                  gs_inventory: DataFrame, ignored_objs: DataFrame, cfg: PlanConfig) -> DataFrame:
    """C4 per row.  ``manifest`` may hold several manifests tagged
    ``manifest_no`` (one pass for all).  ``index_urls`` is ``(did, urls)``.

    Flags: ``no_index`` (no URLs for the id), ``aws_copy_fail`` (neither the
    target nor the flipped-account path listed), ``aws_index_fail`` (both
    s3 URLs missing from the index URLs), ``gs_copy_fail``,
    ``gs_index_fail``.  Zero-size files skip the copy checks.  ``aws_url``
    ends as the flipped path, as in the job; ``gs_url`` is set only when
    copied.  The inventories are taken as given (not restricted to the
    expected buckets).
    """
    platform = cfg.platform
    if platform not in ("AWS", "GS", "ALL"):
        raise ValueError("platform must be AWS, GS or ALL")
    m = manifest if "manifest_no" in manifest.columns else manifest.withColumn("manifest_no", F.lit(0))
    m = attach_projects(m, project_map, cfg)
    first = m.columns
    nonzero = F.col("size") != 0
    known = F.col("known_project")
    aws_bucket, gs_bucket = R.aws_bucket("aws_bucket_prefix", "acl"), R.gs_bucket("gs_bucket_prefix", "acl")
    flip = F.coalesce(R.flip_account(aws_bucket), F.lit("None"))
    aws_key, gs_key = U.object_key("id", "file_name"), U.object_key("id", U.safe_name("file_name"))
    # The rows are shuffled twice.  Their AWS and GS keys differ in blanks only, so one
    # look-up without blanks finds both, and what the listings say is a flag per row; what belongs
    # to the id follows: the structured object, which is looked up apart and
    # brings its listed places along, and the lists of URLs, the widest column.
    listings = [_listing(inv, p) for on, inv, p in ((_aws, aws_inventory, "s3"), (_gs, gs_inventory, "gs")) if on(platform)]
    objects = inventory_by_key(listings[0] if len(listings) == 1 else listings[0].unionByName(listings[1]))
    m = probe_join(m, objects, U.safe_name(aws_key), "_objects", cfg.spread_hot_keys)
    if _aws(platform):
        m = m.withColumn("_on_aws", listed("_objects", _path("s3", aws_bucket, aws_key)) | listed("_objects", _path("s3", flip, aws_key)))
    if _gs(platform):
        m = m.withColumn("_on_gs", listed("_objects", _path("gs", gs_bucket, gs_key)))
    m = m.drop("_objects")
    if _gs(platform):
        place = F.coalesce(F.col("structured_key"), F.lit("None"))
        m = attach_ignored(m, probe_join(ignored_objs, objects, U.safe_name(place), "_places"), "_places")
        m = (m.withColumn("_gs_key", F.when(F.col("is_ignored"), place).otherwise(gs_key))
              .withColumn("_on_gs", F.when(F.col("is_ignored"), listed("_places", _path("gs", gs_bucket, place))).otherwise(F.col("_on_gs")))
              .drop("structured_key", "is_ignored", "_places"))
    idx = index_urls.select(F.col("did").alias("_did"), F.col("urls").alias("_urls"))
    m = (m.join(idx, m["id"] == idx["_did"], "left").drop("_did")
          .withColumn("index_urls", F.coalesce(F.col("_urls"), F.array().cast("array<string>"))).drop("_urls")
          .withColumn("no_index", F.size("index_urls") == 0))
    if _aws(platform):
        copy_fail = known & ~F.col("_on_aws") & nonzero
        m = m.withColumn("aws_bucket", aws_bucket).withColumn("_flip", flip)
        p1 = U.provider_url("s3", "aws_bucket", U.object_key("id", "file_name"))
        p2 = U.provider_url("s3", "_flip", U.object_key("id", "file_name"))
        m = (m.withColumn("aws_copy_fail", F.when(known, copy_fail))
              .withColumn("aws_index_fail", F.when(known, ~copy_fail & nonzero
                                                   & ~F.array_contains("index_urls", p1)
                                                   & ~F.array_contains("index_urls", p2)))
              .withColumn("aws_url", F.when(known & ~copy_fail & nonzero, p2)))
    else:
        m = (m.withColumn("aws_copy_fail", F.lit(None).cast("boolean"))
              .withColumn("aws_index_fail", F.lit(None).cast("boolean"))
              .withColumn("aws_url", F.lit(None).cast("string")))
    if _gs(platform):
        copy_fail = known & ~F.col("_on_gs") & nonzero
        m = m.withColumn("gs_bucket", gs_bucket)
        gs_url = U.provider_url("gs", "gs_bucket", "_gs_key")
        m = (m.withColumn("gs_copy_fail", F.when(known, copy_fail))
              .withColumn("gs_url", F.when(known & ~copy_fail & nonzero, gs_url))
              .withColumn("gs_index_fail", F.when(known, ~copy_fail & nonzero
                                                  & ~F.array_contains("index_urls", gs_url))))
    else:
        m = (m.withColumn("gs_copy_fail", F.lit(None).cast("boolean"))
              .withColumn("gs_index_fail", F.lit(None).cast("boolean"))
              .withColumn("gs_url", F.lit(None).cast("string")))
    aws = ["aws_copy_fail", "aws_index_fail", "aws_url"]
    gs = ["gs_bucket", "gs_copy_fail", "gs_url", "gs_index_fail"] if _gs(platform) else ["gs_copy_fail", "gs_index_fail", "gs_url"]
    m = m.select(*first, "index_urls", "no_index", *(["aws_bucket"] if _aws(platform) else []), *aws, *gs)
    return m.withColumn("reject_reason", F.when(~known, F.lit("unknown_project")))


def _n(c: str):
    return F.sum(F.when(F.coalesce(F.col(c), F.lit(False)), 1).otherwise(0)).cast("bigint")


def validate_counts(rows: DataFrame) -> DataFrame:
    """A4/A5 per manifest: the four failure counters and ``passed``.

    A missing index record adds one to both index counters whatever the
    platform; the URL check adds again."""
    out = rows.groupBy("manifest_no").agg(
        _n("aws_copy_fail").alias("aws_copy_failures"),
        (_n("no_index") + _n("aws_index_fail")).alias("aws_index_failures"),
        _n("gs_copy_fail").alias("gs_copy_failures"),
        (_n("no_index") + _n("gs_index_fail")).alias("gs_index_failures"),
        F.count(F.lit(1)).alias("n_rows"))
    total = F.col("aws_copy_failures") + F.col("aws_index_failures") + F.col("gs_copy_failures") \
        + F.col("gs_index_failures")
    return out.withColumn("passed", total == 0)


FAILURES = ("aws_copy_failures", "aws_index_failures", "gs_copy_failures", "gs_index_failures")


def run_failures() -> list:
    """A4 over a whole run, as metrics for ``DataFrame.observe`` on the rows'
    own write: the run passes (A5) when their sum is 0."""
    return [F.sum(F.coalesce(F.col(a).cast("int"), F.lit(0)) + (F.coalesce(F.col("no_index").cast("int"), F.lit(0)) if "index" in n else F.lit(0))).alias(n)
            for n, a in zip(FAILURES, ("aws_copy_fail", "aws_index_fail", "gs_copy_fail", "gs_index_fail"))]


def with_verdict(rows: DataFrame, counts: DataFrame, force: bool = False) -> DataFrame:
    """Rows with ``passed`` of their manifest, and ``output``: the report they
    go to, ``manifest`` when it passed or ``force`` is set (F7), else ``FAIL_manifest``.
    The verdicts, a row per manifest of the run, are broadcast: a shuffle by
    manifest would put all rows of a manifest into one task."""
    judged = rows.join(F.broadcast(counts.select("manifest_no", "passed")), "manifest_no")
    return judged.withColumn("output", F.when(F.col("passed") | F.lit(force), F.lit("manifest")).otherwise(F.lit("FAIL_manifest")))


def run_report(counts: DataFrame, force: bool = False) -> DataFrame:
    """A4, A5 and F7 of a run: a row per manifest and one, ``manifest_no`` null,
    for the run: counters, whether it passed, and the report that is written."""
    sums = [F.sum(c).alias(c) for c in (*FAILURES, "n_rows")]
    run = counts.agg(*sums, F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed")).withColumn("manifest_no", F.lit(None).cast("int"))
    out = F.when(F.col("manifest_no").isNotNull(), F.when(F.col("passed") | F.lit(force), F.lit("manifest")).otherwise(F.lit("FAIL_manifest")))
    return counts.unionByName(run).withColumn("output", out)


def run_passed(counts: DataFrame) -> bool:
    """A5: the run passes iff every manifest passes (one driver-side bool)."""
    return bool(counts.agg(F.bool_and("passed").alias("ok")).first()["ok"])


FAIL_CHECKS = (
    (1, "no_index_record", "no_index"),
    (2, "aws_copy", "aws_copy_fail"),
    (2, "aws_index", "aws_index_fail"),
    (3, "gs_copy", "gs_copy_fail"),
    (3, "gs_index", "gs_index_fail"),
)


def fail_list(rows: DataFrame) -> DataFrame:
    """One entry per failed check (a row appears up to three times:
    missing record, AWS, GS), with the row's final values; order by
    ``manifest_no, line_no, check_no``."""
    checks = F.array(*[F.struct(F.lit(no).alias("check_no"), F.lit(reason).alias("reason"),
                                F.coalesce(F.col(flag), F.lit(False)).alias("failed"))
                       for no, reason, flag in FAIL_CHECKS])
    failed = F.filter(checks, lambda c: c["failed"])
    out = rows.withColumn("_chk", F.explode(failed))
    return (out.withColumn("check_no", F.col("_chk.check_no")).withColumn("reason", F.col("_chk.reason"))
            .drop("_chk")
            .withColumn("indexd_url", A.py_list_repr("index_urls")))


def augmented_manifest(rows: DataFrame) -> DataFrame:
    """The 15-column augmented manifest (zero-size files dropped);
    ``indexd_url`` rendered as a Python list."""
    r = rows.filter(F.col("size") != 0).withColumn("indexd_url", A.py_list_repr("index_urls"))
    if "case_submitter_ids" not in r.columns:
        r = r.withColumn("case_submitter_ids", F.lit(None).cast("string"))
    return r.select("manifest_no", "line_no", *C.AUGMENTED_COLUMNS)

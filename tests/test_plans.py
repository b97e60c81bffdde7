"""Decision cases of the copy plans (C1, C2), integrity checks (C9), chunk
plans (C10), the executor-side copy (C11), the manifest stream and hot-key
inputs."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from objsync.config import PlanConfig
from objsync.plans import aws, gs, verify as VF
from objsync.plans.pipeline import execute_copies

PM = [("TCGA", "tcga", "gdc-tcga-phs000178"), ("CCLE", "gdc-ccle", "gdc-ccle")]
PM_SCHEMA = "project_id string, aws_bucket_prefix string, gs_bucket_prefix string"
INV_SCHEMA = "bucket string, key string, size bigint, storage_class string"
SRC_SCHEMA = "key string, size bigint, storage_class string"
MAN_SCHEMA = "line_no bigint, id string, file_name string, size bigint, md5 string, acl string, project_id string, url string"
U1 = "2127dca2-e6b7-4e8a-859d-0d7093bd91e6"


def _plan(spark, manifest, inventory, source, buckets=None):
    pm = spark.createDataFrame(PM, PM_SCHEMA)
    b = spark.createDataFrame([(x,) for x in (buckets or ["tcga-2-open", "tcga-2-controlled", "gdc-ccle-2-open",
                                                          "gdc-ccle-controlled"])], "bucket string")
    return {r.line_no: r for r in aws.copy_plan(
        spark.createDataFrame(manifest, MAN_SCHEMA), pm, b, spark.createDataFrame(inventory, INV_SCHEMA),
        spark.createDataFrame(source, SRC_SCHEMA), PlanConfig()).collect()}


def test_aws_decisions(spark):
    man = [
        (0, "a", "f.bam", 5, "m", "['open']", "TCGA", None),  # STANDARD in source -> COPY
        (1, "b", "f.bam", 5, "m", "['open']", "TCGA", None),  # nothing in source -> STREAM, not in summary
        (2, "c", "f.bam", 5, "m", "['open']", "TCGA", None),  # cold -> STREAM
        (3, "d", "f.bam", 5, "m", "['open']", "TCGA", None),  # in opposite bucket -> MOVE
        (4, "e", "f.bam", 5, "m", "['open']", "TCGA", None),  # already there (size differs) -> ALREADY
        (5, "f", "f.bam", 5, "m", "['open']", "TGCA", None),  # unknown project
        (6, U1, "abc", 5, "m", "['phs1']", "CCLE", f"s3://h/backup/{U1}/abc"),  # url key
        (7, "g", "f.bam", 5, "m", "*", "CCLE", None),  # id key; '*' is open for the default branch
        (8, "h", "f.bam", 5, "m", "['phs1']", "CCLE", None),  # controlled bucket missing
    ]
    inv = [("tcga-2-controlled", "d/f.bam", 5, "STANDARD"), ("tcga-2-open", "e/f.bam", 9, "STANDARD")]
    src = [("a/f.bam", 5, "STANDARD"), ("c/f.bam", 5, "GLACIER"), (f"{U1}/abc", 5, None), ("g", 5, "STANDARD_IA")]
    p = _plan(spark, man, inv, src, buckets=["tcga-2-open", "tcga-2-controlled", "gdc-ccle-2-open"])
    assert (p[0].action, p[0].copy_method, p[0].storage_class, p[0].in_summary) == ("COPY", "AWS", "STANDARD", True)
    assert (p[1].action, p[1].copy_method, p[1].in_summary) == ("STREAM", "GDCAPI", False)
    assert (p[2].action, p[2].copy_method, p[2].in_summary) == ("STREAM", "GDCAPI", True)
    assert (p[3].action, p[3].copy_method) == ("MOVE", "AWS")
    assert (p[4].action, p[4].needs_copy) == ("ALREADY_COPIED", True)
    assert (p[5].action, p[5].reject_reason) == ("REJECT", "unknown_project")
    assert (p[6].action, p[6].source_key, p[6].source_priority, p[6].storage_class) == \
        ("REJECT", None, None, None)  # gdc-ccle-controlled does not exist
    assert (p[7].action, p[7].source_key, p[7].source_priority, p[7].target_bucket) == \
        ("COPY", "g", 3, "gdc-ccle-2-open")
    assert (p[8].action, p[8].reject_reason) == ("REJECT", "no_bucket")


def test_aws_url_key_priority(spark):
    man = [(0, U1, "abc", 5, "m", "['open']", "CCLE", f"s3://h/backup/{U1}/abc/x"),
           (1, U1 + "x", "abc", 5, "m", "['open']", "CCLE", "no uuid here")]
    src = [(f"{U1}/abc/x", 5, "INTELLIGENT_TIERING"), (U1, 5, "STANDARD"), (U1 + "x", 5, "STANDARD")]
    p = _plan(spark, man, [], src)
    assert (p[0].source_key, p[0].source_priority, p[0].storage_class) == (f"{U1}/abc/x", 2, "INTELLIGENT_TIERING")
    assert (p[1].source_key, p[1].source_priority) == (U1 + "x", 3)


def test_summary_categories(spark):
    plan = spark.createDataFrame(
        [("GDCAPI", None, True, 10), ("GDCAPI", None, False, 20), ("AWS", "INTELLIGENT_TIERING", True, 30),
         ("AWS", "STANDARD", True, 40), ("AWS", None, True, 50), (None, None, False, 60)],
        "copy_method string, storage_class string, in_summary boolean, size bigint")
    got = {r.category: (r.n_files, r.total_bytes) for r in aws.copy_summary(plan).collect()}
    assert got == {"GDCAPI": (1, 10), "AWS_INTELLIGENT_TIERING": (1, 30), "AWS_OTHER": (2, 90),
                   "STREAM_NOT_COUNTED": (1, 20)}


def test_hot_key_duplicates_keep_all_rows(spark):
    # a third of the manifest repeats one key: every row is planned, none dropped
    man = [(i, "hot" if i % 3 == 0 else f"k{i}", "f.bam", 5, "m", "['open']", "TCGA", None) for i in range(300)]
    inv = [("tcga-2-open", "hot/f.bam", 5, "STANDARD")] * 50 + [("tcga-2-open", "k1/f.bam", 5, "STANDARD")]
    p = _plan(spark, man, [(b, k, s, c) for b, k, s, c in inv], [("k2/f.bam", 5, "STANDARD")])
    assert len(p) == 300
    assert all(p[i].action == "ALREADY_COPIED" for i in range(0, 300, 3))


def test_gs_decisions(spark):
    pm = spark.createDataFrame(PM, PM_SCHEMA)
    buckets = spark.createDataFrame([("gdc-tcga-phs000178-open",), ("gdc-tcga-phs000178-controlled",)], "bucket string")
    man = spark.createDataFrame([
        (0, "a", "f.bam", 0, "m", "['open']", "TCGA", None),  # empty
        (1, "b", "f.bam", 5, "m", "['open']", "TGCA", None),  # unknown project
        (2, "c", "f.bam", 5, "m", "['phs1']", "CCLE", None),  # no bucket
        (3, "d", "f.bam", 5, "m", "['open']", "TCGA", None),  # ignored -> index only
        (4, "e", "f.bam", 5, "m", "['open']", "TCGA", None),  # listed in opposite bucket -> move
        (5, "f", "f.bam", 5, "m", "['open']", "TCGA", None),  # listed -> already
        (6, "g", "f.bam", 5, "m", "['open']", "TCGA", None),  # stream
        (7, "h", "f.bam", 5, "m", "['bad']", "TCGA", None),  # bad acl -> internal error
        (8, "i", "f.bam", 5, "m", None, "TCGA", None),  # null acl -> error
    ], MAN_SCHEMA)
    gsi = spark.createDataFrame([("gdc-tcga-phs000178-controlled", "e/f.bam", 5),
                                 ("gdc-tcga-phs000178-open", "f/f.bam", 5),
                                 ("gdc-tcga-phs000178-open", "A/x.bam", 5)], "bucket string, key string, size bigint")
    ig = gs.ignored_objects(spark.createDataFrame(
        [("d", "gs://5aa919de-0aa0-43ec-9ec3-288481102b6d/tcga/A/x.bam", 5)],
        "gdc_uuid string, gcs_object_url string, gcs_object_size bigint"))
    p = {r.line_no: r for r in gs.copy_plan(man, pm, buckets, gsi, ig, PlanConfig()).collect()}
    assert p[0].action == "SKIP_EMPTY" and "empty file" in p[0].message
    assert p[1].reject_reason == "unknown_project"
    assert p[2].reject_reason == "no_bucket" and p[2].message.endswith("\n")
    assert (p[3].action, p[3].index_url, p[3].copy_success) == \
        ("INDEX_ONLY", "gs://gdc-tcga-phs000178-open/A/x.bam", False)
    assert (p[4].action, p[4].copy_success, p[4].index_success) == ("MOVE", True, True)
    assert p[5].action == "ALREADY_COPIED" and p[5].message == "object f/f.bam successfully copied "
    assert p[6].action == "STREAM"
    assert (p[7].copy_success, p[7].message.startswith("Internal error")) == (False, True)
    assert p[8].action == "ERROR"
    lines = {r.line_no: r.line for r in gs.result_lines(
        gs.copy_plan(man, pm, buckets, gsi, ig, PlanConfig())).collect()}
    assert lines[5] == "f\tf.bam\t5\tm\t['open']\tTCGA\tTrue\tTrue\tobject f/f.bam successfully copied "


def test_gs_job_requires_ignored(spark):
    from objsync import jobs

    empty = spark.createDataFrame([], "gdc_uuid string, gcs_object_url string, gcs_object_size bigint")
    with pytest.raises(ValueError):
        jobs._need_ignored(empty)


def test_verify_order(spark):
    exp = spark.createDataFrame([("a", 3, "m1"), ("b", 3, "m1"), ("c", 3, "m1"), ("d", 3, "m1"), ("e", 3, "m1"),
                                 ("f", 3, "m1")], "id string, size bigint, md5 string")
    stored = spark.createDataFrame([("a", 3, "e"), ("c", 4, "e"), ("d", 3, None), ("e", 3, "e"), ("f", 3, "e")],
                                   "id string, stored_size bigint, etag string")
    recv = spark.createDataFrame([("a", 3, "m1"), ("b", 3, "m1"), ("c", 3, "m1"), ("d", 3, "m1"), ("e", 3, "zz"),
                                  ("f", 2, "m1")], "id string, received_size bigint, content_md5 string")
    got = {r.id: r.result for r in VF.verify_objects(exp, stored, recv).collect()}
    assert got == {"a": "ok", "b": "no_object", "c": "size_stored", "d": "no_etag", "e": "md5", "f": "size_received"}


def test_chunk_plan(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 10), ("d", 4)], "id string, size bigint")
    got = [(r.id, r.part_number, r.start_byte, r.end_byte) for r in VF.chunk_plan(df, 4).orderBy("id", "part_number").collect()]
    assert got == [("b", 1, 0, 0), ("c", 1, 0, 3), ("c", 2, 4, 7), ("c", 3, 8, 9), ("d", 1, 0, 3)]
    assert {r.id: r.received_size for r in VF.received_bytes(VF.chunk_plan(df, 4)).collect()} == {"b": 1, "c": 10, "d": 4}


def test_gs_blob_checks(spark):
    import base64
    import hashlib
    h = hashlib.md5(b"x").hexdigest()
    b64 = base64.b64encode(bytes.fromhex(h)).decode()
    exp = spark.createDataFrame([("a", 1, h), ("b", 1, h), ("c", 1, h)], "id string, size bigint, md5 string")
    blobs = spark.createDataFrame([("a", 1, b64), ("b", 1, base64.b64encode(b"0" * 16).decode())],
                                  "id string, blob_size bigint, md5_base64 string")
    got = {r.id: (r.exists, r.exists_and_match, r.resumable_copy_failed)
           for r in VF.gs_blob_checks(exp, blobs).collect()}
    assert got == {"a": (True, True, False), "b": (True, False, True), "c": (False, False, False)}


def test_execute_copies(spark):
    root = tempfile.mkdtemp(prefix="objsync-copy-")
    src, dst = os.path.join(root, "src"), os.path.join(root, "dst")
    os.makedirs(os.path.join(src, "a"))
    open(os.path.join(src, "a", "f.bam"), "wb").write(b"12345")
    os.makedirs(os.path.join(dst, "tcga-2-controlled", "d"))
    open(os.path.join(dst, "tcga-2-controlled", "d", "f.bam"), "wb").write(b"12345")
    plan = spark.createDataFrame([
        (0, "a", 5, "COPY", "tcga-2-open", "a/f.bam", "a/f.bam", None),
        (1, "d", 5, "MOVE", "tcga-2-open", "d/f.bam", None, None),
        (2, "x", 5, "COPY", "tcga-2-open", "x/f.bam", "x/missing", None),
        (3, "y", 5, "REJECT", None, "y/f.bam", None, "no_bucket"),
    ], "line_no bigint, id string, size bigint, action string, target_bucket string, object_key string, "
       "source_key string, reject_reason string")
    got = {r.line_no: (r.copy_success, r.message) for r in execute_copies(plan, src, dst, dry_run=False).collect()}
    assert got[0][0] and got[1][0] and not got[2][0] and not got[3][0]
    assert open(os.path.join(dst, "tcga-2-open", "a", "f.bam"), "rb").read() == b"12345"
    assert os.path.exists(os.path.join(dst, "tcga-2-open", "d", "f.bam"))
    assert not os.path.exists(os.path.join(dst, "tcga-2-controlled", "d", "f.bam"))


def test_manifest_stream_equals_batch(spark):
    from objsync.sources.fixtures import Fixtures
    from objsync import sinks
    from objsync.streaming.manifest_stream import start_manifest_stream

    from conftest import SF_SMALL
    fx = Fixtures(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="objsync-stream-")
    drop = os.path.join(root, "drop")
    sinks.write_tsv(fx["f_manifest"], drop, fields=["id", "file_name", "md5", "size", "state", "project_id", "baseid",
                                                    "version", "release", "acl", "type", "deletereason", "url"],
                    sort_by="line_no", single_file=True)
    for f in os.listdir(drop):
        if not f.endswith(".csv"):
            os.unlink(os.path.join(drop, f))
    out = os.path.join(root, "out")
    q = start_manifest_stream(spark, drop, out, os.path.join(root, "ckpt"), fx["f_project_map"], fx["f_buckets"],
                              fx["f_inventory_raw"], fx["f_source"])
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = aws.copy_plan(fx["f_manifest"], fx["f_project_map"], fx["f_buckets"], fx["f_inventory_raw"], fx["f_source"],
                         PlanConfig())
    cols = ["line_no", "id", "action", "source_key", "reject_reason"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def _drop(spark, df, folder, name, mtime):
    """A manifest file put into the drop folder."""
    from objsync import sinks

    tmp = tempfile.mkdtemp(prefix="objsync-one-")
    sinks.write_tsv(df, os.path.join(tmp, "w"), fields=STREAM_FIELDS, sort_by="line_no", single_file=True)
    part = next(f for f in os.listdir(os.path.join(tmp, "w")) if f.endswith(".csv"))
    os.makedirs(folder, exist_ok=True)
    os.utime(os.path.join(tmp, "w", part), (mtime, mtime))
    os.rename(os.path.join(tmp, "w", part), os.path.join(folder, name))


STREAM_FIELDS = ["id", "file_name", "md5", "size", "state", "project_id", "baseid", "version", "release", "acl", "type", "deletereason", "url"]


def test_latest_stream_equals_batch_of_last_rows(spark):
    """Files delivered twice, and rows corrected later, over three runs of the stream."""
    from objsync.sources.fixtures import Fixtures
    from objsync.streaming.manifest_stream import latest_plan, start_latest_stream

    from conftest import SF_SMALL
    fx = Fixtures(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="objsync-latest-")
    drop, out = os.path.join(root, "drop"), os.path.join(root, "out")
    man = fx["f_manifest"].withColumn("acl", F.coalesce("acl", F.lit("")))
    fixed = man.withColumn("acl", F.when(F.col("k") % 10 == 0, F.lit("['phs000999']")).otherwise(F.col("acl")))
    runs = [[(man, "a.tsv", 1000)], [(man.filter("k % 2 = 0"), "b.tsv", 2000), (fixed.filter("k % 10 = 0"), "a2.tsv", 3000)], [(fixed.filter("k % 10 = 0"), "0.tsv", 4000)]]
    for files in runs:
        for df, name, mtime in files:
            _drop(spark, df, drop, name, 1_700_000_000 + mtime)
        q = start_latest_stream(spark, drop, out, os.path.join(root, "ckpt"), fx["f_project_map"], fx["f_buckets"], fx["f_inventory_raw"], fx["f_source"])
        q.awaitTermination(300)
    cols = ["id", "acl", "action", "source_key", "storage_class", "needs_copy", "reject_reason"]
    want = aws.copy_plan(fixed, fx["f_project_map"], fx["f_buckets"], fx["f_inventory_raw"], fx["f_source"], PlanConfig())
    got = latest_plan(spark, out)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=str) == sorted((tuple(r) for r in want.select(*cols).collect()), key=str)
    epochs = {r.epoch: r["count"] for r in got.groupBy("epoch").count().collect()}
    assert epochs[2] == fixed.filter("k % 10 = 0").count()


def test_stream_refuses_other_headers(spark):
    from objsync.streaming.manifest_stream import start_manifest_stream

    root = tempfile.mkdtemp(prefix="objsync-head-")
    os.makedirs(os.path.join(root, "drop"))
    with open(os.path.join(root, "drop", "m.tsv"), "w") as f:
        f.write("\t".join(["md5", "file_name", "id", *STREAM_FIELDS[3:]]) + "\n" + "\t".join(["m", "f.bam", "i", "5", *["x"] * 9]) + "\n")
    empty = [spark.createDataFrame([], s) for s in (PM_SCHEMA, "bucket string", INV_SCHEMA, SRC_SCHEMA)]
    q = start_manifest_stream(spark, os.path.join(root, "drop"), os.path.join(root, "out"), os.path.join(root, "ckpt"), *empty)
    with pytest.raises(Exception):
        q.awaitTermination(120)


def test_hot_source_key_does_not_multiply(spark):
    # one source key repeated 300 times and a duplicated project-map entry
    man = [(i, "a", "f.bam", 5, "m", "['open']", "TCGA", None) for i in range(20)]
    src = [("a/f.bam", 5, "STANDARD")] * 300
    pm = spark.createDataFrame(PM + [PM[0]], PM_SCHEMA)
    b = spark.createDataFrame([("tcga-2-open",)], "bucket string")
    plan = aws.copy_plan(spark.createDataFrame(man, MAN_SCHEMA), pm, b, spark.createDataFrame([], INV_SCHEMA),
                         spark.createDataFrame(src, SRC_SCHEMA), PlanConfig()).collect()
    assert len(plan) == 20 and all(r.action == "COPY" and r.source_key == "a/f.bam" for r in plan)


def test_hot_manifest_key_is_spread(spark):
    """A third of the rows share one key: same result, and no task of the probe has twice the median."""
    from objsync.operators.inventory import inventory_by_key, probe_join

    n = 30_000
    man = spark.range(n).selectExpr("id as line_no", "case when id % 3 = 0 then 'hot' when id % 3000 = 1 then null else concat('k', id) end as k")
    inv = spark.range(n).selectExpr("'b' as bucket", "concat('k', id) as key", "id as size", "'STANDARD' as storage_class") \
        .union(spark.sql("select 'b', 'hot', 7L, 'GLACIER'")).union(spark.sql("select 'c', 'hot', 8L, 'STANDARD'"))
    plain, spread = (probe_join(man, inventory_by_key(inv), F.col("k"), spread=s) for s in (0, 64))
    text = lambda df: sorted((r.line_no, str(r.o)) for r in df.select("line_no", F.to_json("objects").alias("o")).collect())
    assert text(plain) == text(spread)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        sizes = lambda df: sorted(r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.max(F.size("objects"))).collect())
        few, many = (sizes(probe_join(man, inventory_by_key(inv), F.col("k"), spread=s)) for s in (0, 64))
        assert few[-1] > 2 * few[len(few) // 2] and many[-1] < 2 * many[len(many) // 2], (few, many)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_inventory_keeps_the_last_listing_in_one_exchange(spark):
    from objsync.operators.inventory import inventory_by_key

    rows = [("a", "k", 1, "X", 1), ("a", "k", 2, None, 2), ("a", "k", 2, None, 2), ("b", "k", 5, "Y", 1), ("b", "k", 4, "Z", 0), ("a", "q", None, None, 3), (None, "q", 1, "n", 1)]
    inv = spark.createDataFrame(rows, INV_SCHEMA + ", seq bigint")
    got = {r.key: {b: (o["size"], o.storage_class) for b, o in r.objects.items()} for r in inventory_by_key(inv).collect()}
    assert got == {"k": {"a": (2, None), "b": (5, "Y")}, "q": {"a": (None, None)}}
    first = {r.key: {b: (o["size"], o.storage_class) for b, o in r.objects.items()} for r in inventory_by_key(inv.drop("seq")).collect()}
    assert first["k"] == {"a": (1, "X"), "b": (4, "Z")}
    plan = inventory_by_key(inv)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in plan


def test_resolve_sources_modes_agree(spark):
    from conftest import SF_SMALL
    from objsync.sources.fixtures import Fixtures

    fx = Fixtures(spark, SF_SMALL)
    args = (fx["f_manifest"], fx["f_project_map"], fx["f_buckets"], fx["f_inventory_raw"], fx["f_source"],
            PlanConfig())
    every, needed, pending = (sorted(tuple(r) for r in aws.copy_plan(*args, resolve_sources=m).collect()) for m in ("all", "needed", "pending"))
    assert every == needed == pending

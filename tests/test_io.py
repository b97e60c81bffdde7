"""Readers and sinks round trips (S1-S13, K1-K6), row positions (W1) and an
end-to-end run of the jobs over files written from the sf0.001 fixtures."""

import json
import os
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

from objsync import jobs, sinks
from objsync.config import PlanConfig
from objsync.operators.relational import with_line_no
from objsync.plans import aws, gs
from objsync.sources import readers as S
from objsync.sources.fixtures import Fixtures

from conftest import SF_MID, SF_SMALL


@pytest.fixture()
def tmp():
    return tempfile.mkdtemp(prefix="objsync-test-")


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


MANIFEST_TSV = (
    "id\tfile_name\tmd5\tsize\tstate\tproject_id\tbaseid\tversion\trelease\tacl\ttype\tdeletereason\turl\n"
    "a1\tx y.bam\tm1\t10\tlive\tP0\tb\t1\t12\t['open']\tt\t\ts3://h/0aaaaaaa-aaaa-aaaa-aaaa-aaaaaaaaaaaa/z\n"
    "a2\tf.bam\tm2\t 20 \tlive\tP1\tb\t1\t12\t['phs1', 'phs2']\tt\t\t\n"
    "a3\tg.bam\tm3\t0\tlive\tP9\tb\t1\t12\t*\tt\t\t\n"
)


def test_read_manifest(spark, tmp):
    p = _write(os.path.join(tmp, "m.tsv"), MANIFEST_TSV)
    rows = S.read_manifest(spark, p).orderBy("line_no").collect()
    assert [r.line_no for r in rows] == [0, 1, 2]
    assert [r.size for r in rows] == [10, 20, 0]
    assert rows[0].file_name == "x y.bam" and rows[1].url == "" and rows[0].deletereason == ""
    assert rows[1].acl == "['phs1', 'phs2']"
    sliced = S.read_manifest(spark, p, start=1, end=2).collect()
    assert [r.id for r in sliced] == ["a2"]


def test_read_manifest_bad_size_fails(spark, tmp):
    p = _write(os.path.join(tmp, "bad.tsv"), "id\tsize\nq\tabc\n")
    with pytest.raises(Exception):
        S.read_manifest(spark, p).collect()


def test_line_no_multi_files(spark, tmp):
    a = _write(os.path.join(tmp, "d", "a.tsv"), "id\tsize\n" + "".join(f"a{i}\t{i}\n" for i in range(5)))
    b = _write(os.path.join(tmp, "d", "b.tsv"), "id\tsize\n" + "".join(f"b{i}\t{i}\n" for i in range(3)))
    rows = S.read_manifest(spark, [a, b]).orderBy("line_no").collect()
    assert [r.id for r in rows] == [f"a{i}" for i in range(5)] + [f"b{i}" for i in range(3)]
    assert [r.line_no for r in rows] == list(range(8))


def test_line_no_matches_file_row_number(spark):
    p = os.path.join(SF_MID, "lineitem.parquet")
    df = spark.read.parquet(p).select("l_orderkey", "l_linenumber", "_metadata.file_path", "_metadata.row_index")
    got = with_line_no(df, block_cols=["file_path"], pos_col="row_index").select("line_no", "l_orderkey",
                                                                                   "l_linenumber")
    got_generated = with_line_no(spark.read.parquet(p).select("l_orderkey", "l_linenumber"))
    want = duckdb.sql(f"select file_row_number, l_orderkey, l_linenumber from read_parquet('{p}', "
                      f"file_row_number=true)").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert sorted(tuple(r) for r in got_generated.select("line_no", "l_orderkey", "l_linenumber").collect()) \
        == sorted(want)


def test_read_pipeline_manifest(spark, tmp):
    p = _write(os.path.join(tmp, "p.txt"),
               "id\tfile_name\tsize\tmd5\tacl\tproject_id\nu1\tx_y.bam\t5\tm\t['open']\tP0\textra\n\nu2\tz\t7\tm2\t*\tP1\n")
    rows = S.read_pipeline_manifest(spark, p).orderBy("line_no").collect()
    assert [(r.id, r.file_name, r.size, r.acl, r.project_id) for r in rows] == \
        [("u1", "x_y.bam", 5, "['open']", "P0"), ("u2", "z", 7, "*", "P1")]


def test_read_json_sources(spark, tmp):
    pm = _write(os.path.join(tmp, "pm.json"), json.dumps(
        {"P0": {"aws_bucket_prefix": "tcga", "gs_bucket_prefix": "gdc-tcga"}, "P1": {"aws_bucket_prefix": "target",
                                                                                   "gs_bucket_prefix": "gdc-t"}}))
    assert sorted(tuple(r) for r in S.read_project_map(spark, pm).collect()) == \
        [("P0", "tcga", "gdc-tcga"), ("P1", "target", "gdc-t")]
    inv = _write(os.path.join(tmp, "inv.json"), json.dumps(
        {"b1/id/f.bam": {"StorageClass": "GLACIER", "Size": 3, "Bucket": "b1"}, "g1/id/x": {"bucket": "g1", "Size": 4}}))
    assert sorted(tuple(r) for r in S.read_inventory_json(spark, inv).collect()) == \
        [("b1", "id/f.bam", 3, "GLACIER"), ("g1", "id/x", 4, None)]
    mp = _write(os.path.join(tmp, "map.json"), json.dumps({"d1": ["u1", "u2"], "d2": []}))
    assert sorted((r.did, list(r.urls)) for r in S.read_index_map_json(spark, mp).collect()) == \
        [("d1", ["u1", "u2"]), ("d2", [])]


def test_read_listing(spark, tmp):
    _write(os.path.join(tmp, "root", "bucket-a", "id1", "f 1.bam"), "abc")
    _write(os.path.join(tmp, "root", "bucket-b", "k"), "hello")
    got = sorted(tuple(r) for r in S.read_listing(spark, os.path.join(tmp, "root")).collect())
    assert got == [("bucket-a", "id1/f 1.bam", 3, None), ("bucket-b", "k", 5, None)]


def test_file_digest(spark, tmp):
    import hashlib
    _write(os.path.join(tmp, "r", "b1", "id", "x.bam"), "hello world")
    got = S.file_digest(spark, os.path.join(tmp, "r")).collect()
    assert [(r.bucket, r.key, r.received_size, r.content_md5) for r in got] == \
        [("b1", "id/x.bam", 11, hashlib.md5(b"hello world").hexdigest())]


def test_ignored_last_wins_and_host(spark, tmp):
    p = _write(os.path.join(tmp, "ig.tsv"),
               "gcs_object_size\tgcs_object_time_stamp\tmd5sum\tacl\tgcs_object_url\tgdc_uuid\n"
               "1\tt\tm\ta\tgs://5aa919de-0aa0-43ec-9ec3-288481102b6d/tcga/A/x.bam\tu1\n"
               "2\tt\tm\ta\tgs://5aa919de-0aa0-43ec-9ec3-288481102b6d/tcga/B/y.bam\tu1\n"
               "3\tt\tm\ta\tgs://elsewhere/tcga/C/z.bam\tu2\n"
               "4\tt\tm\ta\tgs://5aa919de-0aa0-43ec-9ec3-288481102b6d/tcga\tu3\n")
    ig = gs.ignored_objects(S.read_ignored(spark, p), order_col="line_no")
    got = sorted((r.gdc_uuid, r.gcs_object_size, r.structured_key) for r in ig.collect())
    assert got == [("u1", 2, "B/y.bam"), ("u3", 4, None)]


def test_write_tsv_roundtrip(spark, tmp):
    df = spark.createDataFrame([(2, "b", ["u1", "u2"]), (1, "a", [])], "line_no bigint, id string, urls array<string>")
    out = os.path.join(tmp, "o")
    sinks.write_tsv(df, out, fields=["id", "urls"], sort_by="id", single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    text = open(os.path.join(out, files[0])).read().splitlines()
    assert text == ["id\turls", "a\t[]", "b\t['u1', 'u2']"]
    empty = os.path.join(tmp, "e")
    sinks.write_tsv(df.filter(F.lit(False)), empty, fields=["id", "urls"], single_file=True)
    body = "".join(open(os.path.join(empty, f)).read() for f in os.listdir(empty) if f.endswith(".csv"))
    assert body == "id\turls\n"  # header only


def _materialize_inputs(spark, tmp):
    fx = Fixtures(spark, SF_SMALL)
    m = fx["f_manifest"]
    man = os.path.join(tmp, "manifest")
    sinks.write_tsv(m, man, fields=["id", "file_name", "md5", "size", "state", "project_id", "baseid", "version",
                                    "release", "acl", "type", "deletereason", "url"], sort_by="line_no",
                    single_file=True)
    pm = {r.project_id: {"aws_bucket_prefix": r.aws_bucket_prefix, "gs_bucket_prefix": r.gs_bucket_prefix}
          for r in fx["f_project_map"].collect()}
    _write(os.path.join(tmp, "pm.json"), json.dumps(pm))
    paths = {"manifest": man, "project_map": os.path.join(tmp, "pm.json"), "output": os.path.join(tmp, "out")}
    for name, fx_name in [("inventory", "f_inventory_raw"), ("source_inventory", "f_source"),
                          ("buckets", "f_buckets"), ("gs_inventory", "f_gs_inventory")]:
        fx[fx_name].write.parquet(os.path.join(tmp, name))
        paths[name] = os.path.join(tmp, name)
    ig = os.path.join(tmp, "ignored")
    sinks.write_tsv(fx["f_ignored"], ig, single_file=True)
    paths["ignored"] = ig
    from objsync.plans import index as I
    idx = I.index_from_long_form(fx["f_index_urls"], fx["f_index_attrs"])
    idx.write.parquet(os.path.join(tmp, "index"))
    paths["index"] = os.path.join(tmp, "index")
    return fx, paths


def test_jobs_end_to_end(spark, tmp):
    fx, paths = _materialize_inputs(spark, tmp)
    cfg = PlanConfig()
    out = jobs.aws_copy_job(spark, paths, cfg)
    want = aws.copy_plan(fx["f_manifest"], fx["f_project_map"], fx["f_buckets"], fx["f_inventory_raw"],
                         fx["f_source"], cfg)
    key = ["line_no", "action", "source_key", "storage_class", "reject_reason"]
    assert sorted(tuple(r) for r in out["plan"].select(*key).collect()) == \
        sorted(tuple(r) for r in want.select(*key).collect())
    g = jobs.gs_copy_job(spark, paths, cfg)
    assert g["plan"].count() > 0
    assert os.listdir(os.path.join(paths["output"], "results"))
    v = jobs.validation_job(spark, dict(paths, manifests=[paths["manifest"]], platform="ALL"),
                            PlanConfig(platform="ALL"))
    assert v["passed"] is False
    assert os.listdir(os.path.join(paths["output"], "FAIL_manifest")).count("manifest_no=0") == 1
    assert v["failures"] == {c: x for c, x in v["counts"].first().asDict().items() if c in v["failures"]}
    assert out["counters"] == {c: x for c, x in aws.copy_counters(want).first().asDict().items() if c in out["counters"]}
    r = jobs.redaction_job(spark, dict(paths, dry_run=False))
    s = {row.provider: (row.deleted, row.total) for row in r["summary"].collect()}
    assert s["gs"][1] > 0 and s["s3"][1] > 0
    dl = spark.read.json(os.path.join(paths["output"], "deletion_log"))
    assert set(dl.columns) >= {"url", "deleted", "indexdUpdated", "message", "release", "provider"}
    assert dl.count() == r["log"].count()
    lines = spark.read.text(os.path.join(paths["output"], "results")).collect()
    # 9 fields per record; the "no bucket" message ends in a newline (kept
    # literally), which leaves an empty line after those records
    assert lines and all(len(x.value.split("\t")) == 9 or x.value == "" for x in lines)
    assert r["index"].count() <= spark.read.parquet(paths["index"]).count()
    ix = jobs.indexing_job(spark, paths, cfg)
    assert ix["index"].filter("change = 'patched'").count() > 0


def test_manifests_with_other_headers_fail(spark, tmp):
    a, b = os.path.join(tmp, "a.tsv"), os.path.join(tmp, "b.tsv")
    with open(a, "w") as f:
        f.write("md5\tsize\tid\nm1\t5\ti1\n")
    with open(b, "w") as f:
        f.write("id\tsize\tmd5\ni2\t6\tm2\n")
    with pytest.raises(Exception):
        S.read_manifest(spark, [a, b]).collect()


def test_pipeline_manifest_line_that_starts_with_a_tab(spark, tmp):
    p = os.path.join(tmp, "pipe.txt")
    with open(p, "w") as f:
        f.write("id file_name size md5 acl project_id\n\ti1 f1 5 m1 [a] P1\n")
    r = S.read_pipeline_manifest(spark, p).first()
    assert (r.id, r.file_name, r.size, r.md5) == ("i1", "f1", 5, "m1")


def test_logs_are_replaced_by_a_rerun(spark, tmp):
    from objsync import sinks

    log = spark.createDataFrame([("s3", "u", True, True, "m")], "provider string, url string, deleted boolean, indexdUpdated boolean, message string")
    path = os.path.join(tmp, "log")
    for release in ("r1", "r1", "r2"):
        sinks.write_deletion_log(log, path, release)
    assert sorted(r.release for r in spark.read.json(path).collect()) == ["r1", "r2"]


def test_line_numbers_of_split_files(spark, tmp):
    from objsync.streaming.manifest_stream import MANIFEST_STREAM_SCHEMA

    n = 4000
    for name, lo in (("a.tsv", 0), ("b.tsv", n)):
        with open(os.path.join(tmp, name), "w") as f:
            f.write("\t".join(c.split()[0] for c in MANIFEST_STREAM_SCHEMA.split(", ")) + "\n")
            f.writelines(f"i{lo + k}\tf\tm\t1" + "\tx" * 9 + "\n" for k in range(n))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    try:
        df = S.read_manifest(spark, tmp)
        assert spark.read.text(tmp).rdd.getNumPartitions() > 4
        assert all(r.id == f"i{r.line_no}" for r in df.select("id", "line_no").collect()) and df.count() == 2 * n
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_ignored_table_that_is_filled_later(spark, tmp):
    from objsync import jobs

    path = os.path.join(tmp, "ignored")
    schema = "gdc_uuid string, gcs_object_url string, gcs_object_size bigint"
    spark.createDataFrame([], schema).write.parquet(path)
    with pytest.raises(ValueError):
        jobs._need_ignored(spark.read.parquet(path))
    spark.createDataFrame([("a", "gs://h/x", 1)], schema).write.mode("overwrite").parquet(path)
    jobs._need_ignored(spark.read.parquet(path))


def test_project_map_that_grows_at_its_path(spark, tmp):
    from objsync.config import PlanConfig
    from objsync.operators.projects import attach_projects

    path = os.path.join(tmp, "map")
    manifest = spark.createDataFrame([("p1",), ("p250000",), ("q",)], "project_id string")
    for n, known in ((10, {"p1"}), (300_000, {"p1", "p250000"})):
        spark.range(n).selectExpr("'p' || id as project_id", "'a' as aws_bucket_prefix", "'g' as gs_bucket_prefix").write.mode("overwrite").parquet(path)
        out = attach_projects(manifest, spark.read.parquet(path), PlanConfig())
        assert {r.project_id for r in out.filter("known_project").collect()} == known
    with pytest.raises(Exception, match="project map has no key q"):
        attach_projects(manifest, spark.read.parquet(path), PlanConfig(on_unknown_project="fail")).collect()

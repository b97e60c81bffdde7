"""Small operators without a registered query: U2, W6, W7, S7 missing
buckets, K4 and K6."""

import os
import tempfile

from pyspark.sql import functions as F

from objsync import sinks
from objsync.operators.inventory import missing_buckets
from objsync.operators.relational import chunk_id, union_last_wins
from objsync.sources import readers as S


def test_union_last_wins(spark):
    first = spark.createDataFrame([("d1", ["u1"]), ("d2", ["u2"])], "did string, urls array<string>")
    later = spark.createDataFrame([("d1", ["u9"])], "did string, urls array<string>")
    got = {r.did: list(r.urls) for r in union_last_wins([first, later], ["did"]).collect()}
    assert got == {"d1": ["u9"], "d2": ["u2"]}


def test_chunk_ids_and_shuffle_key(spark):
    df = spark.range(0, 250).withColumnRenamed("id", "line_no")
    got = {r.c: r.n for r in df.groupBy(chunk_id(100).alias("c")).agg(F.count("*").alias("n")).collect()}
    assert got == {0: 100, 1: 100, 2: 50}
    root = tempfile.mkdtemp(prefix="objsync-small-")
    p = os.path.join(root, "m.tsv")
    with open(p, "w") as f:
        f.write("id\tsize\n" + "".join(f"a{i}\t{i}\n" for i in range(20)))
    a = S.read_manifest(spark, p, shuffle_seed=7).orderBy("rand_key").select("id").collect()
    b = S.read_manifest(spark, p, shuffle_seed=7).orderBy("rand_key").select("id").collect()
    assert a == b and sorted(r.id for r in a) == sorted(f"a{i}" for i in range(20))


def test_missing_buckets(spark):
    expected = spark.createDataFrame([("aws", "b-open"), ("aws", "b-controlled")], "provider string, bucket string")
    inv = spark.createDataFrame([("b-open", "k", 1, None)], "bucket string, key string, size bigint, storage_class string")
    assert [(r.provider, r.bucket) for r in missing_buckets(expected, inv).collect()] == [("aws", "b-controlled")]


def test_result_log_and_snapshot(spark):
    root = tempfile.mkdtemp(prefix="objsync-small-")
    plan = spark.createDataFrame(
        [(0, "a", "x y.bam", 5, "m", "*", "P0", True, True, "ok")],
        "line_no bigint, id string, file_name string, size bigint, md5 string, acl string, project_id string, "
        "copy_success boolean, index_success boolean, message string")
    sinks.write_result_log(plan, os.path.join(root, "log"), release="r1")
    back = spark.read.parquet(os.path.join(root, "log")).collect()
    assert back[0].release == "r1" and back[0].line.split("\t")[1] == "x_y.bam"
    sinks.write_snapshot(plan, os.path.join(root, "snap"))
    assert spark.read.parquet(os.path.join(root, "snap")).count() == 1

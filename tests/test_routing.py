"""Bucket routing rules (P3-P7, P15) against the job's golden cases."""

import pytest
from pyspark.sql import functions as F

from objsync.functions import routing as R

OPEN, CLOSED = "['open']", "['phs7']"

# prefix -> buckets for an open and for a controlled file
TARGETS = {
    "gdc-rebc-thyr-phs001134": ("gdc-rebc-thyr-phs001134-open", "gdc-rebc-thyr-phs001134-controlled"),
    "gdc-cgci-phs000235": ("gdc-cgci-phs000235-2-open", "gdc-cgci-phs000235-2-controlled"),
    "any-other": ("any-other-2-open", "any-other-controlled"),
    "tcga": ("tcga-2-open", "tcga-2-controlled"),
    "target": ("gdc-target-phs000218-2-open", "target-controlled"),
}
AWS_CASES = [(p, a, b[k]) for p, b in TARGETS.items() for k, a in ((0, OPEN), (0, "[u'open']"), (1, CLOSED), (1, ""), (1, None))]
# a star opens all but the two fixed programs
AWS_CASES += [(p, "*", b[1 if p in ("tcga", "target") else 0]) for p, b in TARGETS.items()]

REVERSED = [(x, y) for a, b in TARGETS.values() for x, y in ((a, b), (b, a))] + [("nothing", None)]

FLIPS = [(s + a, s + b) for s in ("data", "m-n") for a, b in (("-open", "-2-open"), ("-2-open", "-open"), ("-controlled", "-2-controlled"), ("-2-controlled", "-controlled"))]
FLIPS += [("data", None), ("-open", "-2-open"), ("open", None)]


def test_aws_bucket(spark):
    df = spark.createDataFrame(AWS_CASES, "prefix string, acl string, want string")
    got = df.select("want", R.aws_bucket("prefix", "acl").alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_aws_bucket_unknown_project_is_null(spark):
    df = spark.createDataFrame([(None, "['open']")], "prefix string, acl string")
    assert df.select(R.aws_bucket("prefix", "acl").alias("b")).first().b is None


@pytest.mark.parametrize("acl,want", [("['open']", "-open"), ("[u'open']", "-open"), ("*", "-open"),
                                      ("['phs1']", "-controlled"), (None, "-controlled")])
def test_gs_bucket(spark, acl, want):
    df = spark.createDataFrame([("gdc-x", acl)], "prefix string, acl string")
    assert df.select(R.gs_bucket("prefix", "acl").alias("b")).first().b == "gdc-x" + want


def test_reversed_bucket(spark):
    df = spark.createDataFrame(REVERSED, "b string, want string")
    for r in df.select("want", R.aws_reversed_bucket("b").alias("got")).collect():
        assert r.got == r.want


def test_flip(spark):
    df = spark.createDataFrame(FLIPS, "b string, want string")
    for r in df.select("want", R.flip_account("b").alias("got")).collect():
        assert r.got == r.want


@pytest.mark.parametrize("acl,want", [("['open']", "gdc-x-controlled"), ("*", "gdc-x-open"),
                                      ("['phs1']", "gdc-x-open")])
def test_gs_reversed_uses_substring(spark, acl, want):
    bucket = "gdc-x-open" if acl == "['open']" else "gdc-x-controlled"
    df = spark.createDataFrame([(bucket, acl)], "b string, acl string")
    assert df.select(R.gs_reversed_bucket("b", "acl").alias("r")).first().r == want


def test_expected_buckets(spark):
    df = spark.createDataFrame([(p,) for p in TARGETS], "p string")
    for r in df.select("p", R.aws_expected_buckets("p").alias("b")).collect():
        assert set(r.b) == set(TARGETS[r.p])


def test_acl_changed_probe(spark):
    # the object sits in the opposite-ACL bucket -> the plan moves it
    from objsync.operators.inventory import inventory_by_key, listed, probe_join

    inv = spark.createDataFrame([("tcga-controlled", "test_id/test_file_name", 1, None),
                                 ("gdc-ccle-2-open", "test_id/test_file_name", 1, None)],
                                "bucket string, key string, size bigint, storage_class string")
    m = spark.createDataFrame([("test_id/test_file_name", "tcga-open"), ("test_id/test_file_name", "gdc-ccle-controlled")],
                              "k string, target string")
    out = probe_join(m, inventory_by_key(inv), F.col("k"))
    got = out.select(listed("objects", R.aws_reversed_bucket("target")).alias("moved")).collect()
    assert all(r.moved for r in got)

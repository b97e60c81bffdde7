"""Property tests: Spark expressions vs plain-Python models written from the
survey's rule descriptions, on generated batches (one Spark job per batch)."""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from objsync import config as C
from objsync.functions import routing as R
from objsync.functions import urls as U

STEMS = ["tcga", "target", "gdc-ccle", "x", "gdc-cmi-mbc-phs001709", "gdc-cgci-phs000235", "a-tcga-b", "open",
         "gdc-rebc-thyr-phs001134", "tcga-target"]
ACLS = ["['open']", "[u'open']", "*", "['phs1']", "[phs000178]", "", None, "open", "['opened']"]

acl = st.sampled_from(ACLS)


FORMS = st.sampled_from(["-open", "-controlled", "-2-open", "-2-controlled"])
NAMES = st.sampled_from(["alpha", "gdc-ccle", "x-y", "gdc-cmi-mbc-phs001709", "gdc-cgci-phs000235"])


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.builds(str.__add__, NAMES, FORMS), min_size=1, max_size=60))
def test_flip_is_its_own_inverse(spark, buckets):
    df = frame(spark, [(b,) for b in buckets], "b string")
    for r in df.select("b", R.flip_account("b").alias("f"), R.flip_account(R.flip_account("b")).alias("ff")).collect():
        assert r.ff == r.b and r.f != r.b and ("open" in r.f) == ("open" in r.b)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([s for s in STEMS if s != "open"] + ["tcga-x", "gdc-beataml1-cohort-phs001657"]), acl), min_size=1, max_size=80))
def test_targets_are_expected_and_reverse_in_pairs(spark, rows):
    df = frame(spark, rows, "p string, acl string").withColumn("b", R.aws_bucket("p", "acl"))
    out = df.select("p", "acl", "b", R.aws_reversed_bucket("b").alias("r"), R.aws_reversed_bucket(R.aws_reversed_bucket("b")).alias("rr"),
                    R.aws_expected_buckets("p").alias("e"))
    for r in out.collect():
        assert ("controlled" in r.b) != ("open" in r.b.replace(r.p, "")) or "target" in r.b
        if "tcga" not in r.p or r.p == "tcga":
            assert r.rr == r.b and r.r != r.b
        if "tcga" not in r.p:
            assert {r.b, r.r} == set(r.e)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(NAMES, acl), min_size=1, max_size=60))
def test_gs_buckets_reverse_in_pairs(spark, rows):
    df = frame(spark, rows, "p string, acl string").withColumn("b", R.gs_bucket("p", "acl"))
    for r in df.select("p", "acl", "b", R.gs_reversed_bucket("b", "acl").alias("r"), R.gs_expected_buckets("p").alias("e")).collect():
        assert r.b in r.e
        if r.acl is None:
            assert r.r is None
        elif r.acl in ("['open']", "[u'open']", "['phs1']", "[phs000178]", ""):
            assert {r.b, r.r} == set(r.e)


def m_urlparse(u):
    # scheme://netloc/path?query#fragment, scheme lower-cased
    m = re.match(r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$", u)
    if not m:
        return "", "", ""
    return m.group(1).lower(), m.group(2), m.group(3)


def m_structured(u):
    parts = [p for p in m_urlparse(u)[2].split("/")[2:] if p]
    return "/".join(parts) if parts else None


UUIDS = ["2127dca2-e6b7-4e8a-859d-0d7093bd91e6", "2127DCA2-E6B7-4E8A-859D-0D7093BD91E6", "abc"]
url = st.builds(lambda sc, host, parts, u, q: f"{sc}://{host}/" + "/".join(parts + [u]) + q,
                st.sampled_from(["s3", "gs", "HTTPS", "gs"]), st.sampled_from(["b", C.IGNORED_HOST, "h-1.x"]),
                st.lists(st.sampled_from(["tcga", "DIR0", "x y.bam", "", "a"]), max_size=4),
                st.sampled_from(UUIDS + ["f.bam"]), st.sampled_from(["", "?a=1", "#frag", "?q#f"]))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(url | st.text(max_size=12), min_size=1, max_size=80))
def test_url_rules_model(spark, urls):
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    out = df.select(U.url_scheme("u").alias("s"), U.url_netloc("u").alias("n"), U.url_path("u").alias("p"),
                    U.structured_key("u").alias("k"), U.uuid_tail_key("u").alias("t")).collect()
    for u, r in zip(urls, out):
        s, n, p = m_urlparse(u)
        m = re.search(C.UUID_TAIL_PATTERN, u)
        assert (r.s, r.n, r.p) == (s, n, p), u
        assert r.k == m_structured(u), u
        assert r.t == (m.group(0) if m else None), u


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(url, min_size=1, max_size=80))
def test_url_parts_match_urllib(spark, urls):
    from urllib.parse import urlparse

    df = spark.createDataFrame([(u,) for u in urls], "u string")
    out = df.select(U.url_scheme("u").alias("s"), U.url_netloc("u").alias("n"), U.url_path("u").alias("p"),
                    U.url_query("u").alias("q"), U.url_fragment("u").alias("f")).collect()
    for u, r in zip(urls, out):
        p = urlparse(u)
        assert (r.s, r.n, r.p, r.q, r.f) == (p.scheme, p.netloc, p.path, p.query, p.fragment), u

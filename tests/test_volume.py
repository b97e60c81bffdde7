"""What the plans read, shuffle and write once only."""

import gzip
import os
import re
from contextlib import contextmanager

from pyspark.sql import functions as F

from conftest import SF_SMALL
from objsync import registry, sinks
from objsync.config import SPECIAL_URL_BUCKET_PAIR, PlanConfig
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.plans import index as I, index_table as T, validation as V
from objsync.sources.fixtures import Fixtures


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_url_is_matched_once_for_its_class(spark):
    urls = ["s3://a-open/k", "S3://a-2-controlled/k?x#y", "gs://x", "s3://ccle-open-access/k", "s3://ccle-o-open/k", "gs://gdc-ccle-controlled/k", "s3://special-open/k",
            "a+b.c-1://u:p@h:1/://x", "nothing", "", None, "s3:///k", "1s://b/k", "s3://b\n/k", "s3://b/k#f\ng", "https://h?q://z"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    netloc = U.url_netloc("url")
    stem = R.bucket_project_stem(netloc)
    special = stem.isin(*[n[:-5] if n.endswith("-open") else n[:-11] for n in SPECIAL_URL_BUCKET_PAIR])
    plain = F.concat(U.url_scheme("url"), F.lit("://"), F.when(special, F.lit("/special")).otherwise(stem))
    both = df.select(I.url_class(F.col("url")).alias("one"), plain.alias("two"), I._class_and_odd(F.col("url"))["odd"].alias("odd"),
                     (special & ~netloc.isin(*SPECIAL_URL_BUCKET_PAIR)).alias("odd2"))
    for r in both.collect():
        assert r.one == r.two and r.odd == r.odd2, r
    assert _plan(df.select(I.url_class(F.col("url")).alias("c"))).count("regexp_extract(") == 1


def test_index_urls_join_last(spark):
    joins = [line for line in _plan(registry.QUERIES["validate_rows"](spark, SF_SMALL)).splitlines() if "Join LeftOuter" in line]
    assert len(joins) >= 4 and re.search(r"id#\d+ = _?did#\d+", joins[0])


def test_index_input_is_written_once(spark):
    f = Fixtures(spark, SF_SMALL)
    rows = f.derived("snapshot", lambda: I.index_from_long_form(f.unwritten("f_index_urls"), f.unwritten("f_index_attrs"))).count()
    assert rows == f["f_manifest"].filter("k % 7 <> 0").count() > 0
    assert not {"f_index_urls", "f_index_attrs"} & set(f._cache)
    assert f.unwritten("f_index_urls").exceptAll(f["f_index_urls"]).isEmpty() and f.unwritten("f_index_urls") is f["f_index_urls"]


def test_run_report_validates_once(spark):
    assert "LeftOuter" not in _plan(registry.QUERIES["validate_run"](spark, SF_SMALL))


def test_deletion_log_is_compressed(spark, tmp_path):
    log = spark.createDataFrame([("s3", "s3://b/k", True, True, None), ("gs", "gs://b/k", False, False, "m")], "provider string, url string, deleted boolean, indexdUpdated boolean, message string")
    for _ in range(2):
        sinks.write_deletion_log(log, str(tmp_path / "log"), "r1")
    names = [n for _, _, files in os.walk(tmp_path / "log") for n in files if n.startswith("part-")]
    assert len(names) == 2 and all(n.endswith(".json.gz") for n in names)
    assert sorted((r.provider, r.url, r.deleted) for r in spark.read.json(str(tmp_path / "log")).collect()) == [("gs", "gs://b/k", False), ("s3", "s3://b/k", True)]


@contextmanager
def _no_broadcast(spark):
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(keep, ("-1", "false")):
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_validated_rows_are_shuffled_twice(spark):
    """Once by the key of both listings, once by id; both listings together once."""
    with _no_broadcast(spark):
        plan = _executed(registry.QUERIES["validate_rows"](spark, SF_SMALL))
    keys = re.findall(r"[+-] Exchange hashpartitioning\((\w+)#", plan)
    assert keys.count("id") == 1 and keys.count("key") == 1 and keys.count("_probe") == 2, keys  # one _probe is the structured objects'


def test_validation_looks_up_exact_keys(spark):
    """Keys that differ in blanks only share a look-up, not an answer."""
    names = ["a b", "a_b", "c  d", "plain", " x ", "s/t", None]
    ids = ["i1", "i 2", "i_2", "i/3", None]
    man = [(n, i, f, n % 5, "P0" if n % 4 else "P9", "['open']" if n % 2 else "['phs1']") for n, (i, f) in enumerate((i, f) for i in ids for f in names)]
    m = spark.createDataFrame(man, "line_no bigint, id string, file_name string, size bigint, project_id string, acl string")
    pm = spark.createDataFrame([("P0", "proj", "gproj")], "project_id string, aws_bucket_prefix string, gs_bucket_prefix string")
    aws = [("proj-2-open", "i1/a b"), ("proj-open", "i1/a_b"), ("proj-controlled", "i 2/c  d"), ("proj-2-controlled", "i_2/plain"), ("proj-2-open", "i 2/a b"), ("proj-controlled", "i/3/s/t"),
           (None, "i1/plain"), ("other", "i1/plain"), ("proj-2-open", None), ("proj-2-open", "i_2/_x_"), ("proj-controlled", "i_2/ x ")]
    gs = [("gproj-open", "i1/a_b"), ("gproj-controlled", "i1/a b"), ("gproj-controlled", "i 2/c__d"), ("gproj-open", "i 2/c__d"), ("gproj-open", "i_2/plain"), ("gproj-controlled", "i_2/plain"), ("gproj-open", "D/x y"),
          ("gproj-controlled", "D/x_y"), ("gproj-open", "None"), ("gproj-open", "i/3/_x_"), ("gproj-controlled", "i/3/_x_"), (None, "i1/plain")]
    inv = lambda rows: spark.createDataFrame([(b, k, 1, "S") for b, k in rows], "bucket string, key string, size bigint, storage_class string")
    structured = {"i_2": None, "i 2": "D/x y"}
    ig = spark.createDataFrame([(g, k) for g, k in structured.items()], "gdc_uuid string, structured_key string")
    urls = spark.createDataFrame([("i1", ["s3://proj-open/i1/a_b", "gs://gproj-open/i1/a_b"])], "did string, urls array<string>")
    for platform in ("ALL", "AWS", "GS"):
        got = {r.line_no: r for r in V.validate_rows(m, pm, urls, inv(aws), inv(gs), ig, PlanConfig(platform=platform)).collect()}
        assert len(got) == len(man)
        for n, i, f, size, project, acl in man:
            if project != "P0" or not size:
                continue
            side = "open" if acl == "['open']" else "controlled"
            key = None if i is None or f is None else f"{i}/{f}"
            buckets = ("proj-2-open", "proj-open") if side == "open" else ("proj-controlled", "proj-2-controlled")
            gkey = (structured[i] or "None") if i in structured else key and f"{i}/{f.replace(' ', '_')}"
            if platform != "GS":
                assert got[n].aws_copy_fail == (not any((b, key) in aws for b in buckets if key)), (platform, got[n])
            if platform != "AWS":
                assert got[n].gs_copy_fail == (not (gkey and (f"gproj-{side}", gkey) in gs)), (platform, got[n])
                assert got[n].gs_url == (None if got[n].gs_copy_fail else f"gs://gproj-{side}/{gkey}")


def test_verdicts_do_not_shuffle_rows(spark):
    rows = spark.range(10).selectExpr("cast(id % 2 as int) as manifest_no", "id", "id % 2 = 1 as aws_copy_fail", "false as no_index", "false as aws_index_fail", "false as gs_copy_fail", "false as gs_index_fail")
    with _no_broadcast(spark):
        judged = V.with_verdict(rows, V.validate_counts(rows))
        plan = _executed(judged)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert {(r.id % 2, r.output) for r in judged.collect()} == {(0, "manifest"), (1, "FAIL_manifest")}


def test_report_rows_are_made_after_the_shuffle(spark, tmp_path):
    """Files are gzipped and in row order; the shuffle has a row per row of the manifest."""
    df = spark.range(50).selectExpr("cast(id % 2 as int) as no", "49 - id as line_no", "concat('f ', id) as name", "sequence(1, 1 + id % 3) as checks")
    plans = []

    def report(rows):
        out = rows.withColumn("check_no", F.explode("checks"))
        plans.append(_plan(out))
        return out

    sinks.write_tsv_by(df, str(tmp_path / "r"), "no", ["name", "line_no", "check_no"], ["line_no", "check_no"], report=report)
    assert plans[0].index("Generate") < plans[0].index("RepartitionByExpression")
    want = {(r.no, r.line_no, r.name, c) for r in df.collect() for c in r.checks}
    for no in (0, 1):
        names = sorted(n for n in os.listdir(tmp_path / "r" / f"no={no}") if not n.startswith((".", "_")))
        assert names and all(n.endswith(".csv.gz") for n in names)
        lines = []
        for n in names:
            head, *body = gzip.open(tmp_path / "r" / f"no={no}" / n, "rt").read().splitlines()
            assert head == "name\tline_no\tcheck_no"
            lines += [x.split("\t") for x in body]
        got = [(no, int(line), name, int(check)) for name, line, check in lines]
        assert got == sorted(want & set(got), key=lambda x: (x[1], x[3])) and len(got) == sum(x[0] == no for x in want)


def test_written_inputs_are_small(spark):
    f = Fixtures(spark, SF_SMALL)
    names = [n for n in os.listdir(re.sub("^file:", "", os.path.dirname(f["f_manifest"].inputFiles()[0]))) if n.startswith("part-")]
    assert names and all(n.endswith(".zstd.parquet") for n in names)


def test_bucket_of_an_index_is_written_where_it_is_merged(spark, tmp_path):
    """Tasks hold dids of one bucket, so that no second shuffle brings them together."""
    cfg, path = PlanConfig(data_api_url="https://api/"), str(tmp_path / "idx")
    dids = [f"d{i}" for i in range(300)] + [None]
    idx = spark.createDataFrame([(d, [f"s3://p-open/{d}"], {f"s3://p-open/{d}": {}}, ["*"], ["/open"], {"md5": "m"}, 1) for d in dids], I.INDEX_SCHEMA)
    rows = spark.createDataFrame([(n, d, "['phs1']", "m", 5, f"s3://p-controlled/{d}") for n, d in enumerate([*dids[::2], "new"])], "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    ups = I.index_updates(rows, cfg)
    for buckets in (5, 16):
        n = T._tasks(spark, buckets)
        assert n % buckets == 0 and n >= int(spark.conf.get("spark.sql.shuffle.partitions"))
        with _no_broadcast(spark):
            merged = I.merge_index(idx, ups, cfg, partitions=n)
            per_task = merged.groupBy(F.spark_partition_id()).agg(F.count_distinct(T.did_bucket(F.col("did"), buckets)).alias("n")).collect()
            assert max(r.n for r in per_task) == 1 and len(per_task) > 1
    T.create_index_table(idx, path, 16)
    want = {(r.did, tuple(r.urls), tuple(r.acl)) for r in I.merge_index(idx, ups, cfg).collect()}
    assert len(T.merge_into(spark, path, ups, cfg, 16)) == 16
    assert {(r.did, tuple(r.urls), tuple(r.acl)) for r in T.read_index_table(spark, path).collect()} == want
    names = [n for _, _, files in os.walk(path) for n in files if n.startswith("part-")]
    assert len(names) <= T._tasks(spark, 16) and all(n.endswith(".zstd.parquet") for n in names)

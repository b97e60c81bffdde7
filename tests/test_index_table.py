"""Edits of the bucketed index rewrite only what they touch."""

import os

from objsync.config import PlanConfig
from objsync.plans import index as I, index_table as T


def _files(path):
    return {d: sorted(f for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")) for d in os.listdir(path) if d.startswith("did_bucket=")}


def _index(spark, n):
    rows = [(f"d{i}", [f"s3://p-open/d{i}"], {f"s3://p-open/d{i}": {}}, ["*"], ["/open"], {"md5": f"m{i}"}, i) for i in range(n)]
    return spark.createDataFrame(rows, I.INDEX_SCHEMA)


def _rows(df):
    return {r.did: (r.urls, sorted(r.urls_metadata), r.acl, r.authz, r.hashes, r["size"]) for r in df.collect()}


def test_edits_touch_their_buckets_only(spark, tmp_path):
    path, cfg = str(tmp_path / "idx"), PlanConfig(data_api_url="https://api/")
    idx = _index(spark, 200)
    T.create_index_table(idx, path, 16)
    before = _files(path)
    assert len(before) == 16 and _rows(T.read_index_table(spark, path)) == _rows(idx)

    rows = spark.createDataFrame([(1, "d7", "['phs1']", "m", 5, "s3://p-controlled/d7"), (2, "new", "['open']", "m", 5, "gs://q-open/new"), (3, "d9", "['bad']", "m", 5, "s3://p-controlled/d9")],
                                 "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    ups = I.index_updates(rows, cfg)
    want = I.merge_index(idx, ups, cfg)
    touched = T.merge_into(spark, path, ups, cfg, 16)
    after = _files(path)
    assert 1 <= len(touched) <= 2 and {d for d in after if after[d] != before.get(d)} == {f"did_bucket={b}" for b in touched}
    assert _rows(T.read_index_table(spark, path)) == _rows(want)

    gone = spark.createDataFrame([("d3", "s3://p-open/d3"), ("nobody", "x")], "did string, url string")
    T.remove_urls_from(spark, path, gone, 16)
    assert _rows(T.read_index_table(spark, path)) == _rows(I.remove_index_urls(want, gone))
    assert T.delete_from(spark, path, gone.limit(0), 16) == []


def test_emptied_buckets_go(spark, tmp_path):
    path = str(tmp_path / "idx")
    T.create_index_table(_index(spark, 5), path, 4)
    T.delete_from(spark, path, spark.createDataFrame([(f"d{i}",) for i in range(4)], "did string"), 4)
    assert [r.did for r in T.read_index_table(spark, path).collect()] == ["d4"] and len(_files(path)) == 1


def test_edits_read_their_buckets_only(spark, tmp_path):
    path = str(tmp_path / "idx")
    T.create_index_table(_index(spark, 50), path, 8)
    plan = T.read_index_table(spark, path).filter("did_bucket in (3)")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(did_bucket" in plan or "PartitionFilters: [(did_bucket" in plan


def test_bucketed_snapshot_is_joined_without_an_exchange(spark, tmp_path):
    from objsync import sinks
    from objsync.jobs import _index as read

    name = f"objsync_idx_{os.getpid()}"
    idx = _index(spark, 40)
    man = spark.createDataFrame([(i, f"d{i * 3}") for i in range(20)], "line_no bigint, id string")
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        sinks.write_bucketed_snapshot(idx, name, "did", int(spark.conf.get("spark.sql.shuffle.partitions")))
        for k, v in zip(keep, ("-1", "false")):
            spark.conf.set(k, v)
        missing = I.missing_from_index(man, read(spark, f"table:{name}"))
        assert sorted(r.id for r in missing.collect()) == sorted(f"d{i * 3}" for i in range(20) if i * 3 >= 40)
        plan = missing._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan  # the manifest's
        assert _rows(read(spark, f"table:{name}")) == _rows(idx)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
        spark.sql(f"drop table if exists {name}")

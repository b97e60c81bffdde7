"""Index merge (C6, P22), URL removal (C7) and ACL parsing (P17-P20),
checked against a plain-Python row model written from the job semantics."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from objsync.config import PlanConfig
from objsync.functions import acl as A
from objsync.plans import index as I


# --- plain-Python model -----------------------------------------------------

def split_url(u):
    from urllib.parse import urlsplit

    p = urlsplit(u)
    return p.scheme, p.netloc


def same_project(a, b):
    """Buckets that differ in their access suffix alone, or the special pair."""
    if sorted((a, b)) == ["ccle-open-access", "gdc-ccle-controlled"]:
        return True
    stem = lambda x: x.removesuffix("-open") if x.endswith("-open") else x[: -len("-controlled")]
    return stem(a) == stem(b)


def model_remove_changed(urls, meta, url):
    """Of each stretch of neighbouring URLs that the new one replaces, the 1st,
    3rd, 5th ... go; the others stay."""
    scheme, bucket = split_url(url)
    replaced = [split_url(u)[0] == scheme and same_project(bucket, split_url(u)[1]) for u in urls]
    kept, metas = [], dict(meta)
    for hit, stretch in itertools.groupby(zip(replaced, urls), key=lambda x: x[0]):
        names = [u for _, u in stretch]
        gone = names[::2] if hit else []
        kept += [u for u in names if u not in gone]
        for u in gone:
            metas.pop(u, None)
    return kept, metas


def model_acl(acl):
    if acl in ("[u'open']", "['open']"):
        return ["*"], ["/open"], True
    items = [a.strip().replace("u'", "").replace("'", "") for a in (acl or "").strip()[1:-1].split(",")]
    return items, ["/programs/" + a for a in items], all(a.startswith("phs") for a in items)


def model_update(doc, did, url, acl, md5, size, api):
    """The record after one update, as a value of its parts."""
    wanted, resources, accepted = model_acl(acl)
    if not accepted:
        return doc
    if doc is None:
        return dict(urls=[api + did, url], meta={}, acl=wanted, authz=resources, md5=md5, size=size or 0, changed=True, new=True)
    known = url in doc["urls"]
    urls, meta = (doc["urls"], doc["meta"]) if known else model_remove_changed(doc["urls"], doc["meta"], url)
    parts = {name: old if sorted(set(old)) == sorted(set(new)) else new for name, old, new in (("acl", doc["acl"], wanted), ("authz", doc["authz"], resources))}
    moved = not known or any(parts[n] is not doc[n] for n in parts)
    return doc | parts | {"urls": urls if known else [*urls, url], "meta": meta, "changed": doc["changed"] or moved}


# --- tests ------------------------------------------------------------------

INDEX_SCHEMA = I.INDEX_SCHEMA


def _index_df(spark, docs):
    rows = [(d, v["urls"], {u: {} for u in v["meta"]}, v["acl"], v["authz"], {"md5": "m"}, 1)
            for d, v in docs.items()]
    return spark.createDataFrame(rows, INDEX_SCHEMA)


def test_remove_changed_url_golden(spark):
    df = spark.createDataFrame(
        [(["s3://tcga-open/uuid1/filename1", "gs://gdc-tcga-open/uuid1/filename1"], "s3://tcga-controlled/uuid1/filename1"),
         (["s3://ccle-open-access/uuid1/filename1", "gs://gdc-ccle-open/uuid1/filename1"],
          "s3://gdc-ccle-controlled/uuid1/filename1")],
        "urls array<string>, url string")
    got = df.select(I.remove_changed_urls(F.col("urls"), F.col("url")).alias("r")).collect()
    assert got[0].r.kept == ["gs://gdc-tcga-open/uuid1/filename1"]
    assert got[1].r.kept == ["gs://gdc-ccle-open/uuid1/filename1"]


def test_remove_changed_url_skips_after_removal(spark):
    urls = ["s3://a-open/1", "s3://a-2-controlled/2", "s3://a-controlled/3", "s3://a-open/4"]
    url = "s3://a-controlled/new"
    want, _ = model_remove_changed(urls, {}, url)
    df = spark.createDataFrame([(urls, url)], "urls array<string>, url string")
    got = df.select(I.remove_changed_urls(F.col("urls"), F.col("url")).alias("r")).first().r
    assert got.kept == want == ["s3://a-2-controlled/2", "s3://a-open/4"]


def test_remove_changed_url_random_vs_model(spark):
    rnd = random.Random(7)
    buckets = ["p-open", "p-controlled", "p-2-open", "p-2-controlled", "q-open", "q-controlled",
               "ccle-open-access", "gdc-ccle-controlled"]
    cases = []
    for _ in range(300):
        n = rnd.randint(0, 6)
        urls = list(dict.fromkeys(f"{rnd.choice(['s3', 'gs'])}://{rnd.choice(buckets)}/k{rnd.randint(0, 9)}"
                                  for _ in range(n)))
        url = f"s3://{rnd.choice(buckets)}/new"
        cases.append((urls, url))
    df = spark.createDataFrame(cases, "urls array<string>, url string")
    got = df.select(I.remove_changed_urls(F.col("urls"), F.col("url")).alias("r")).collect()
    for (urls, url), r in zip(cases, got):
        assert r.r.kept == model_remove_changed(urls, {}, url)[0]


@pytest.mark.parametrize("acl", ["['phs000218',  'phs000219']", "['open']", "[u'open']", "*", "['bad']", None,
                                 "[u'phs1', u'phs2']", "  ['phs9'] "])
def test_acl_parse_vs_model(spark, acl):
    df = spark.createDataFrame([(acl,)], "acl string")
    r = df.select(A.acl_list("acl").alias("a"), A.authz_list("acl").alias("z"), A.acl_valid("acl").alias("ok")).first()
    a, z, ok = model_acl(acl)
    assert (r.a, r.z, r.ok) == (a, z, ok)


def test_update_url_golden(spark):
    cfg = PlanConfig()
    docs = {"uuid1": {"urls": ["s3://tcga-2-open/uuid1/filename1"], "meta": ["s3://tcga-2-open/uuid1/filename1"],
                      "acl": ["*"], "authz": ["/open"]}}
    idx = _index_df(spark, docs)
    rows = spark.createDataFrame(
        [(1, "uuid1", "['phs000218',  'phs000219']", "m", 1, "s3://tcga-2-controlled/uuid1/filename1")],
        "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    out = I.merge_index(idx, I.index_updates(rows, cfg), cfg).first()
    assert out.acl == ["phs000218", "phs000219"]
    assert out.urls == ["s3://tcga-2-controlled/uuid1/filename1"]
    assert out.urls_metadata == {}
    assert out.change == "patched"
    rows2 = spark.createDataFrame(
        [(1, "uuid1", "['open']", "m", 1, "gs://gdc-tcga-phs000178-open/uuid1/filename1")],
        "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    out2 = I.merge_index(idx, I.index_updates(rows2, cfg), cfg).first()
    assert out2.urls == ["s3://tcga-2-open/uuid1/filename1", "gs://gdc-tcga-phs000178-open/uuid1/filename1"]
    assert out2.change == "patched"


def test_merge_multi_update_fold_vs_model(spark):
    """Several updates of one did fold in line order (pytest-only case)."""
    cfg = PlanConfig(data_api_url="https://api/")
    rnd = random.Random(11)
    buckets = ["p-open", "p-controlled", "p-2-open", "q-open", "q-controlled"]
    acls = ["['open']", "['phs1']", "['phs1', 'phs2']", "['bad']", "*"]
    docs, updates = {}, []
    for i in range(40):
        did = f"d{i}"
        if rnd.random() < 0.7:
            urls = list(dict.fromkeys(f"s3://{rnd.choice(buckets)}/{did}" for _ in range(rnd.randint(0, 4))))
            docs[did] = {"urls": urls, "meta": list(urls), "acl": ["*"], "authz": ["/open"]}
        for j in range(rnd.randint(0, 5)):
            updates.append((len(updates), did, rnd.choice(acls), "m" + did, 5,
                            f"{rnd.choice(['s3', 'gs'])}://{rnd.choice(buckets)}/{did}"))
    idx = _index_df(spark, docs)
    rows = spark.createDataFrame(updates, "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    got = {r.did: r for r in I.merge_index(idx, I.index_updates(rows, cfg), cfg).collect()}
    for did in sorted(set(docs) | {u[1] for u in updates}):
        doc = None
        if did in docs:
            d = docs[did]
            doc = {"urls": d["urls"], "meta": {u: {} for u in d["meta"]}, "acl": d["acl"], "authz": d["authz"],
                   "md5": "m", "size": 1, "changed": False, "new": False}
        for (ln, udid, acl, md5, size, url) in sorted(updates):
            if udid == did:
                doc = model_update(doc, did, url, acl, md5, size, cfg.data_api_url)
        r = got.get(did)
        if doc is None:
            assert r is None  # only failed updates: nothing created
            continue
        assert r.urls == doc["urls"], did
        assert sorted(r.urls_metadata) == sorted(doc["meta"]), did
        assert r.acl == doc["acl"] and r.authz == doc["authz"], did
        if doc.get("new"):
            assert r.change == "created"
        elif any(u[1] == did and model_acl(u[2])[2] for u in updates):
            assert r.change == ("patched" if doc["changed"] else "unchanged"), did


def test_remove_index_urls_keeps_order(spark):
    docs = {"a": {"urls": ["u1", "u2", "u3"], "meta": ["u1", "u2", "u3"], "acl": ["*"], "authz": ["/open"]}}
    idx = _index_df(spark, docs)
    rm = spark.createDataFrame([("a", "u2"), ("a", "u2")], "did string, url string")
    r = I.remove_index_urls(idx, rm).first()
    assert r.urls == ["u1", "u3"] and sorted(r.urls_metadata) == ["u1", "u3"] and r.updated


def test_delete_and_missing(spark):
    docs = {"a": {"urls": [], "meta": [], "acl": ["*"], "authz": ["/open"]},
            "b": {"urls": [], "meta": [], "acl": ["*"], "authz": ["/open"]}}
    idx = _index_df(spark, docs)
    assert [r.did for r in I.delete_index_records(idx, spark.createDataFrame([("a",)], "did string")).collect()] == ["b"]
    man = spark.createDataFrame([(1, "a"), (2, "c")], "line_no bigint, id string")
    assert [r.id for r in I.missing_from_index(man, idx).collect()] == ["c"]


def test_merge_hot_record(spark):
    """A third of the updates repeat one record: same result as one update."""
    cfg = PlanConfig(data_api_url="https://api/")
    docs = {"hot": {"urls": ["s3://p-open/hot"], "meta": ["s3://p-open/hot"], "acl": ["*"], "authz": ["/open"]}}
    idx = _index_df(spark, docs)
    ups = [(i, "hot" if i % 3 == 0 else f"d{i}", "['phs1']", "m", 5, "s3://p-controlled/x") for i in range(600)]
    rows = spark.createDataFrame(ups, "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    got = {r.did: r for r in I.merge_index(idx, I.index_updates(rows, cfg), cfg).collect()}
    assert got["hot"].urls == ["s3://p-controlled/x"] and got["hot"].acl == ["phs1"] and got["hot"].change == "patched"
    assert len(got) == 1 + 400 and all(got[f"d{i}"].change == "created" for i in range(1, 600) if i % 3)


def test_merge_changes_only(spark):
    cfg = PlanConfig(data_api_url="https://api/")
    docs = {"a": {"urls": ["s3://p-open/a"], "meta": ["s3://p-open/a"], "acl": ["*"], "authz": ["/open"]},
            "b": {"urls": ["s3://p-open/b"], "meta": ["s3://p-open/b"], "acl": ["*"], "authz": ["/open"]}}
    idx = _index_df(spark, docs)
    rows = spark.createDataFrame([(1, "a", "['phs1']", "m", 5, "s3://p-controlled/a"), (2, "c", "['open']", "m", 5,
                                                                                        "s3://p-open/c")],
                                 "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    full = {r.did: r for r in I.merge_index(idx, I.index_updates(rows, cfg), cfg).collect()}
    delta = {r.did: r for r in I.merge_index(idx, I.index_updates(rows, cfg), cfg, changes_only=True).collect()}
    assert set(full) == {"a", "b", "c"} and set(delta) == {"a", "c"}
    for d in delta:
        assert delta[d] == full[d]


def _model_merge(docs, updates, api):
    out = {}
    for did in set(docs) | {u[1] for u in updates}:
        d = docs.get(did)
        doc = d and {"urls": d["urls"], "meta": {u: {} for u in d["meta"]}, "acl": d["acl"], "authz": d["authz"], "md5": "m", "size": 1, "changed": False, "new": False}
        for _, udid, acl, md5, size, url in updates:
            if udid == did:
                doc = model_update(doc, did, url, acl, md5, size, api)
        out[did] = doc
    return out


@pytest.mark.parametrize("block", [1, 7, 100, 10**6])
def test_transitions_of_any_blocks(spark, block):
    """Blocks of any size give the records of one update after another: clean records, records with
    several URLs of a class, the special pair and its neighbours."""
    cfg = PlanConfig(data_api_url="s3://api-open/")
    rnd = random.Random(block)
    buckets = ["p-open", "p-controlled", "p-2-open", "q-open", "ccle-open-access", "gdc-ccle-controlled", "gdc-ccle-open", "api-controlled"]
    acls = ["['open']", "[u'open']", "['phs1']", "['phs1', 'phs2']", "['phs2','phs1']", "['bad']"]
    docs, updates = {}, []
    for i in range(60):
        did = f"d{i}"
        pool = buckets if i % 2 else buckets[:4]
        if rnd.random() < 0.7:
            urls = list(dict.fromkeys(f"{rnd.choice(['s3', 'gs'])}://{rnd.choice(pool)}/{did}" for _ in range(rnd.randint(0, 4 if i % 3 else 1))))
            docs[did] = {"urls": urls, "meta": list(urls), "acl": rnd.choice([["*"], ["phs1"], ["phs2", "phs1"]]), "authz": rnd.choice([["/open"], ["/programs/phs1"]])}
        for _ in range(rnd.choice([0, 1, 2, 12])):
            updates.append((did, rnd.choice(acls[: rnd.randint(1, 6)]), f"m{len(updates)}", rnd.choice([5, None]), f"{rnd.choice(['s3', 'gs', 'S3'])}://{rnd.choice(pool)}/{rnd.choice([did, 'x'])}"))
    rnd.shuffle(updates)
    updates = [(n, *u) for n, u in enumerate(updates)]
    rows = spark.createDataFrame(updates, "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    got = {r.did: r for r in I.merge_index(_index_df(spark, docs), I.index_updates(rows, cfg), cfg, block=block).collect()}
    for did, doc in _model_merge(docs, updates, cfg.data_api_url).items():
        if doc is None:
            assert did not in got
            continue
        r = got[did]
        assert (r.urls, sorted(r.urls_metadata), r.acl, r.authz) == (doc["urls"], sorted(doc["meta"]), doc["acl"], doc["authz"]), did
        if doc["new"]:
            assert r.change == "created" and r.hashes == {"md5": doc["md5"]} and r["size"] == doc["size"]
        elif any(u[1] == did and model_acl(u[2])[2] for u in updates):
            assert r.change == ("patched" if doc["changed"] else "unchanged"), did


def test_hot_record_is_spread(spark):
    """A third of interleaved updates on one record: rows of a block per task, one row per
    block and track beyond."""
    cfg = PlanConfig()
    urls = ["s3://p-open/x", "s3://p-controlled/x", "gs://p-open/x"]
    ups = [(i, "hot" if i % 3 == 0 else f"d{i}", "['phs1']" if i % 2 else "['open']", "m", 5, urls[i % 7 % 3]) for i in range(6000)]
    rows = spark.createDataFrame(ups, "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    up = I.index_updates(rows, cfg)
    plan = I.index_transitions(up, cfg, block=100)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "did" in plan
    hot = I.index_transitions(up, cfg, block=100).filter("did = 'hot'").first()
    of_class = {}
    for n, did, _, _, _, url in ups:
        if did == "hot":
            cls = url[:2]
            if of_class.get(cls, (None, None))[1] != url:
                of_class[cls] = (n, url)
    assert sorted((t.at, t.url) for t in hot.tracks) == sorted(of_class.values())
    assert hot.head.line_no == 0 and not hot.acl_single and hot.acl_first == "['open']"

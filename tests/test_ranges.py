"""Inputs read by byte ranges: JSON dictionaries and part digests."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from objsync.plans import verify as VF
from objsync.sources import jsondict, ranges, readers

ODD = ['a"b', "back\\", "\\\\", '\\"', "{", "}", "[]", "a,b", ":", "ü🙂", "", " ", "\t\n", '","x":{"', "x" * 300, '\\\\"', "null"]


def _values(rnd, shape):
    if shape == "urls":
        return [rnd.choice(ODD) + str(rnd.randint(0, 9)) for _ in range(rnd.randint(0, 4))]
    return {"Bucket": rnd.choice(ODD), "StorageClass": rnd.choice(ODD), "Size": str(rnd.randint(0, 10**12))}


def _read(spark, path, kind, **kw):
    return {r.key: r.value for r in jsondict.read_dictionary(spark, path, kind, **kw).collect()}


@pytest.mark.parametrize("shape,kind", [("urls", "array<string>"), ("object", "map<string,string>")])
@pytest.mark.parametrize("indent", [None, 2])
def test_any_cut_gives_the_same_rows(spark, tmp_path, shape, kind, indent):
    rnd = random.Random(len(shape) + (indent or 0))
    doc = {rnd.choice(ODD) + str(i): _values(rnd, shape) for i in range(120)}
    path = tmp_path / "d.json"
    path.write_text(json.dumps(doc, indent=indent, ensure_ascii=rnd.random() < 0.5))
    for range_bytes in (97, 1009, 1 << 20):
        assert _read(spark, str(path), kind, range_bytes=range_bytes, lot_bytes=500) == doc


def test_every_cut_of_a_small_document(spark, tmp_path):
    doc = {'k"\\': ["\\\\", 'a"', "{[,"], "": [], "n": ["x\\\\\\\""]}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    for n in range(1, 24):
        assert _read(spark, str(tmp_path / "d.json"), "array<string>", range_bytes=n) == doc


def test_empty_repeated_and_broken_documents(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    assert _read(spark, put("e.json", " { } "), "array<string>") == {}
    assert _read(spark, put("r.json", '{"a": ["1"], "b": ["2"], "a": ["3"]}'), "array<string>", range_bytes=4) == {"a": ["3"], "b": ["2"]}
    for broken in ('{"a": ["1"]', '{"a": ["1}', '{"a": [1,,]}'):
        with pytest.raises(Exception):
            _read(spark, put("x.json", broken), "array<string>", range_bytes=5)


def test_ranges_are_not_put_into_one_task(spark, tmp_path, monkeypatch):
    """The rows that name ranges are few and small; their bytes are not."""
    doc = {f"key {i}": ["u" * 40] for i in range(800)}
    (tmp_path / "d.json").write_text(json.dumps(doc))
    size = (tmp_path / "d.json").stat().st_size
    monkeypatch.setattr(ranges, "TASK_BYTES", 1_000)
    files = ranges.list_files(spark, str(tmp_path / "d.json"))
    assert ranges.range_tasks(files, 100) == -(-size // 1_000) > spark.sparkContext.defaultParallelism
    assert ranges.range_tasks(files, size) == 1
    assert ranges.range_tasks(files.filter("length < 0"), 100) == 1
    # 40 ranges; AQE made one task of them
    assert ranges.file_ranges(files, -(-size // 40)).rdd.getNumPartitions() == min(40, max(-(-size // 1_000), spark.sparkContext.defaultParallelism))
    assert _read(spark, str(tmp_path / "d.json"), "array<string>", range_bytes=100) == doc


def test_readers(spark, tmp_path):
    inv = {f"bkt-{i % 3}/id{i}/f, \"{i}\".bam": {"Bucket": f"bkt-{i % 3}", "Size": i, "StorageClass": None if i % 4 else "GLACIER"} for i in range(60)}
    (tmp_path / "inv.json").write_text(json.dumps(inv))
    rows = readers.read_inventory_json(spark, str(tmp_path / "inv.json"), range_bytes=333).collect()
    assert {f"{r.bucket}/{r.key}": (r.size, r.storage_class) for r in rows} == {k: (v["Size"], v["StorageClass"]) for k, v in inv.items()}
    gs = {f"g/id{i}": {"bucket": "g", "Size": i} for i in range(9)}
    (tmp_path / "gs.json").write_text(json.dumps(gs))
    assert {(r.bucket, r.key, r["size"]) for r in readers.read_inventory_json(spark, str(tmp_path / "gs.json"), 50).collect()} == {("g", f"id{i}", i) for i in range(9)}
    pm = {f"P{i}": {"aws_bucket_prefix": f"a{i}", "gs_bucket_prefix": f"g{i}"} for i in range(20)}
    (tmp_path / "pm.json").write_text(json.dumps(pm))
    assert {r.project_id: (r.aws_bucket_prefix, r.gs_bucket_prefix) for r in readers.read_project_map(spark, str(tmp_path / "pm.json"), 64).collect()} == {
        k: tuple(v.values()) for k, v in pm.items()}


def test_json_index_can_be_merged(spark, tmp_path):
    from objsync.config import PlanConfig
    from objsync.plans import index as I

    doc = {"a": ["s3://p-open/a"], "b": []}
    (tmp_path / "idx.json").write_text(json.dumps(doc))
    idx = readers.read_index_json(spark, str(tmp_path / "idx.json"))
    assert idx.schema.simpleString() == spark.createDataFrame([], I.INDEX_SCHEMA).schema.simpleString()
    rows = spark.createDataFrame([(1, "a", "['phs1']", "m", 5, "s3://p-controlled/a"), (2, "c", "['open']", "m", 5, "s3://p-open/c")],
                                 "line_no bigint, id string, acl string, md5 string, size bigint, url string")
    cfg = PlanConfig(data_api_url="https://api/")
    got = {r.did: r for r in I.merge_index(idx, I.index_updates(rows, cfg), cfg).collect()}
    assert got["a"].urls == ["s3://p-controlled/a"] and got["a"].acl == ["phs1"] and got["a"].change == "patched" and got["a"].urls_metadata == {}
    assert got["b"].urls == [] and got["b"].change == "untouched" and got["c"].urls == ["https://api/c", "s3://p-open/c"]


def etag(data, chunk):
    parts = [data[i : i + chunk] for i in range(0, len(data), chunk)]
    return hashlib.md5(b"".join(hashlib.md5(p).digest() for p in parts)).hexdigest() + f"-{len(parts)}"


def test_parts_of_files_and_of_contents(spark, tmp_path):
    rnd = random.Random(3)
    files = {("b1", "x/one"): rnd.randbytes(1000), ("b1", "two"): rnd.randbytes(4096), ("b2", "y z/3"): b"", ("b2", "4"): b"q"}
    for (b, k), data in files.items():
        p = tmp_path / "root" / b / k
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(data)
    root = str(tmp_path / "root")
    whole = {(r.bucket, r.key): r for r in readers.file_digest(spark, root).collect()}
    assert {k: (len(d), hashlib.md5(d).hexdigest()) for k, d in files.items() if d} == {k: (r.received_size, r.content_md5) for k, r in whole.items()}
    parts = readers.file_parts(spark, root, 512)
    got = {(r.bucket, r.key): r for r in VF.combine_parts(parts, "bucket", "key").collect()}
    for k, d in files.items():
        if d:
            assert (got[k].received_size, got[k].multipart_etag, got[k].complete) == (len(d), etag(d, 512), True)
            assert [p.part_number for p in got[k].parts] == list(range(1, len(got[k].parts) + 1))
    objects = spark.createDataFrame([(f"{b}/{k}", d) for (b, k), d in files.items()], "id string, c binary")
    same = {r.id: r.multipart_etag for r in VF.combine_parts(VF.content_parts(objects, 512, "id", "c"), "id").collect()}
    assert same == {f"{b}/{k}": etag(d, 512) for (b, k), d in files.items() if d}


def test_verify_parts(spark):
    data = bytes(range(256)) * 10
    objects = spark.createDataFrame([(i, data) for i in range(7)] + [(7, b"")], "id long, c binary")
    parts = VF.content_parts(objects, 1000, "id", "c")
    parts = parts.filter("not (id = 5 and part_number = 2)").unionByName(parts.filter("id = 0"))  # a part lost, parts twice
    good = etag(data, 1000)
    rows = [(0, 2560, 2560, f'"{good}"'), (1, 2560, None, None), (2, 2560, 2561, good), (3, 2560, 2560, None), (4, 2560, 2560, "0" * 32 + "-3"),
            (5, 2560, 2560, good), (6, 2561, 2560, good), (7, 0, 0, "d41d8cd98f00b204e9800998ecf8427e")]
    exp = spark.createDataFrame(rows, "id long, size long, stored_size long, etag string")
    got = {r.id: r.result for r in VF.verify_parts(exp, parts, "id").collect()}
    assert got == {0: "ok", 1: "no_object", 2: "size_stored", 3: "no_etag", 4: "etag", 5: "size_received", 6: "size_received", 7: "ok"}


def test_object_above_two_gib(spark, tmp_path):
    size = (1 << 31) + 12345
    p = tmp_path / "root" / "b" / "big"
    p.parent.mkdir(parents=True)
    with open(p, "wb") as f:  # a sparse file
        f.truncate(size - 3)
        f.seek(size - 3)
        f.write(b"end")
    want = hashlib.md5()
    for _ in range((size - 3) >> 20):
        want.update(bytes(1 << 20))
    want.update(bytes((size - 3) % (1 << 20)) + b"end")
    r = readers.file_digest(spark, str(tmp_path / "root")).first()
    assert (r.key, r.received_size, r.content_md5) == ("big", size, want.hexdigest())
    whole = VF.combine_parts(readers.file_parts(spark, str(tmp_path / "root"), 256 << 20), "bucket", "key").first()
    assert whole.received_size == size and whole.complete and whole.multipart_etag.endswith("-9")
    assert spark.range(1).select(F.lit(whole.parts[0].part_md5)).first()[0] == hashlib.md5(bytes(256 << 20)).hexdigest()

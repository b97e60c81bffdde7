import gzip
import hashlib

from pyspark.sql import functions as F

from objsync.llm import warc as W


def test_round_trip(spark, tmp_path):
    big = "<html>" + "x" * 200
    rows = [(3, "http://a/3\r\nX: y", big, 1), (1, "http://a/1 %41é", big, 1), (2, None, None, 1), (4, "u", "small", 1), (5, "u", "small", 1), (None, "n", big, 1), (1, "again", big, 1),
            (6, "long", "é" * 3_000_000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    path = str(tmp_path / "w")
    W.write_warc(W.to_records(pages), path)
    got = W.read_warc(spark, path).collect()
    by = {}
    for r in got:
        by.setdefault(r.record_id, []).append(r)
    assert by["<urn:page:3>"][0].record_type == "revisit" and by["<urn:page:3>"][0].payload is None and by["<urn:page:3>"][0].target_uri == "http://a/3\r\nX: y"
    assert [r.record_type for r in by["<urn:page:1>"]] == ["response", "response"] and by["<urn:page:none>"][0].refers_to == "<urn:page:1>"
    assert bytes(by["<urn:page:6>"][0].payload) == ("é" * 3_000_000).encode() and by["<urn:page:2>"][0].target_uri is None
    for r in got:
        if r.record_type == "response":
            assert r.payload_digest == "sha256:" + hashlib.sha256(r.payload).hexdigest() and r.payload_bytes == len(r.payload)


def test_pushdown_skips_payloads(spark, tmp_path):
    path = tmp_path / "one.warc"
    row = {"record_id": "<a>", "record_type": "response", "target_uri": "http://x/1", "date": "d", "payload": b"body", "payload_bytes": 4}
    damaged = W.record(row | {"record_id": "<b>", "target_uri": "http://y/2"}).replace(b"\x1f\x8b", b"zz")  # its payload cannot be decoded
    path.write_bytes(W.record(row) + damaged + W.record(row | {"record_id": "<c>", "record_type": "revisit", "refers_to": "<a>"}))
    df = W.read_warc(spark, str(path))
    assert [r.record_id for r in df.filter("record_type = 'revisit'").collect()] == ["<c>"]
    assert [bytes(r.payload) for r in df.filter(F.col("target_uri").startswith("http://x") & (F.col("record_type") == "response")).collect()] == [b"body"]
    assert df.filter("record_id in ('<a>', '<c>') and payload_bytes > 3").count() == 2
    assert W.read_warc(spark, str(path), payload=False).count() == 3
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "two.warc.gz").write_bytes(gzip.compress(W.record(row)) + gzip.compress(W.record(row | {"record_id": "<b>"})))
    assert sorted(r.record_id for r in W.read_warc(spark, str(tmp_path / "z")).collect()) == ["<a>", "<b>"]


def test_indexed_archives_are_split(spark, tmp_path):
    import os

    rows = [(i, "u", os.urandom(300_000).hex()) for i in range(30)]
    path = str(tmp_path / "w")
    W.write_warc(W.to_records(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)), path)
    reader = W.WarcReader({"path": path, "part_bytes": str(4 << 20)})
    parts = reader.partitions()
    assert len(parts) > 1 and sorted(r for p in parts for b in reader.read(p) for r in b.column("record_id").to_pylist()) == sorted(f"<urn:page:{i}>" for i in range(30))


def test_empty(spark, tmp_path):
    path = str(tmp_path / "w")
    W.write_warc(W.to_records(spark.createDataFrame([], "page_id long, url string, html string")), path)
    assert W.read_warc(spark, path).count() == 0


def test_append_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "w")

    def pages(ids):
        return W.to_records(spark.createDataFrame([(i, "u", f"page {i}") for i in ids], "page_id long, url string, html string"))

    def ids():
        return sorted(r.record_id for r in W.read_warc(spark, path).collect())

    W.write_warc(pages([1, 2, 3]), path)
    W.write_warc(pages([4, 5]), path)
    assert ids() == [f"<urn:page:{i}>" for i in range(1, 6)]
    W.write_warc(pages([7]), path, mode="overwrite")
    assert ids() == ["<urn:page:7>"] and len(list((tmp_path / "w").glob("*.warc"))) == 1
    (tmp_path / "w" / "part-left-by-a-lost-task.warc").write_bytes(b"WARC/1.1\r\n")
    assert ids() == ["<urn:page:7>"]


def test_damaged_archives_fail(spark, tmp_path):
    import pytest

    row = {"record_id": "<a>", "record_type": "response", "target_uri": "u", "date": "d", "payload": b"body" * 50, "payload_bytes": 200}
    whole = W.record(row)
    for name, data in (("cut.warc", whole + whole[:-40]), ("head.warc", whole.replace(b"Content-Length", b"Content-Longth")), ("none.warc", b"nothing\r\n")):
        (tmp_path / name).write_bytes(data)
        for payload in (True, False):
            with pytest.raises(Exception, match="WARC record|Content-Length|ends within"):
                W.read_warc(spark, str(tmp_path / name), payload=payload).collect()
    (tmp_path / "ok.warc").write_bytes(b"\r\n\r\n" + whole + b"\r\n" + whole + b"\r\n\r\n")
    assert W.read_warc(spark, str(tmp_path / "ok.warc")).count() == 2

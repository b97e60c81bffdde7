"""WARC archives as a Spark data source.

``spark.read.format("warc")`` gives one row per record (columns of ``SCHEMA``)
and ``df.write.format("warc")`` takes such rows.  The reader plans one
partition per archive, or several per archive that this writer indexed; takes
over predicates on the record type and on the header columns; reads a record's
headers first; and seeks past the block of every record that the predicates or
``option("payload", "false")`` do not want, so its payload is neither read nor
decoded.  Predicates reach the reader because ``register`` switches Spark's
filter pushdown for Python sources on.

Response blocks are HTTP messages whose body has a gzip transfer encoding;
revisit records hold HTTP headers only and name the record they repeat.
Writing tasks may be retried: only files named in an index are part of an
archive folder.  Every commit writes an index of its own, so appending adds to what is there;
``overwrite`` takes the older indexes and their files away after its own is written.

A record without Content-Length, and an archive that ends within a record,
fail the read; line ends between records and at the end are skipped.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, In, InputPartition, IsNotNull, StringStartsWith, WriterCommitMessage)

from objsync.llm.common import scratch_path, ship, table, written

SCHEMA = "record_id string, record_type string, target_uri string, date string, refers_to string, payload_digest string, payload_bytes bigint, headers map<string,string>, payload binary"
COLUMNS = ("record_id", "record_type", "target_uri", "date", "refers_to", "payload_digest", "payload_bytes")
#: Fixed values of the format.
FIELD = {"record_id": "WARC-Record-ID", "record_type": "WARC-Type", "target_uri": "WARC-Target-URI", "date": "WARC-Date", "refers_to": "WARC-Refers-To",
         "payload_digest": "WARC-Payload-Digest", "payload_bytes": "X-Payload-Length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: gzip\r\n\r\n"
INDEX = "_index"
PART_BYTES = 64 << 20  # a partition of an indexed archive
BATCH_BYTES = 4 << 20


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path within it."""
    if re.match(r"file:/+", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    if re.match(r"\w+://", path):
        return pafs.FileSystem.from_uri(path)
    return pafs.LocalFileSystem(), path


def record(row: dict) -> bytes:
    """One record as it stands in an archive."""
    head = ["WARC/1.1"]
    for column, field in FIELD.items():
        if row.get(column) is not None:
            head.append(f"{field}: {quote(str(row[column]), safe=_SAFE)}")
    if row["record_type"] == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        block = HTTP_HEAD
    else:
        squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
        block = HTTP_HEAD + squeeze.compress(row["payload"] or b"") + squeeze.flush()
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


#: Header values keep every printable character but the escape itself.
_SAFE = "".join(chr(c) for c in range(32, 127) if chr(c) != "%")


def read_headers(stream) -> dict[str, str] | None:
    """Headers of the record that starts here; None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {line[:40]!r}")
    headers = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        headers[name.strip()] = value.strip()
    return headers


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message, its gzip transfer encoding undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:\s*gzip", head):
        return gzip.decompress(body)
    return body


def columns_of(headers: dict[str, str]) -> dict:
    from urllib.parse import unquote

    lower = {k.lower(): v for k, v in headers.items()}
    out = {c: lower.get(f.lower()) for c, f in FIELD.items()}
    out = {c: v if v is None else unquote(v) for c, v in out.items()}
    out["payload_bytes"] = None if out["payload_bytes"] is None else int(out["payload_bytes"])
    return out


def indexes(fs: pafs.FileSystem, top: str) -> dict[str, list[dict]]:
    """The indexes of an archive folder, by path: their files and marks."""
    found = fs.get_file_info(pafs.FileSelector(top, allow_not_found=True)) if fs.get_file_info([top])[0].type != pafs.FileType.File else []
    out = {}
    for f in sorted(f.path for f in found if re.fullmatch(rf"{INDEX}.*\.json", f.base_name)):
        with fs.open_input_stream(f) as data:
            out[f] = json.loads(data.read())
    return out


def _past(stream, size: int, end: int | None) -> None:
    """Go on by ``size`` bytes, which must exist."""
    to = stream.tell() + size
    if stream.seek(size, io.SEEK_CUR) < to or end is not None and to > end:
        raise ValueError("the archive ends within a record")


@dataclass
class Span(InputPartition):
    """Records of one file from byte ``start`` up to ``end`` (None: its end)."""

    path: str
    start: int
    end: int | None


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.want_payload = options.get("payload", "true").lower() != "false"
        self.part_bytes = int(options.get("part_bytes", PART_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters):
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if column not in COLUMNS:
                yield f
            elif isinstance(f, (EqualTo, EqualNullSafe)):
                self.tests.append((column, "in", (f.value,)))
            elif isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif isinstance(f, IsNotNull):
                self.tests.append((column, "some", None))
            elif isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            else:
                yield f

    def wants(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            x = row[column]
            if kind == "some" and x is None or kind == "in" and x not in value or kind == "starts" and not (x or "").startswith(value):
                return False
        return True

    def partitions(self) -> list[Span]:
        fs, top = file_system(self.path)
        listed = indexes(fs, top)
        if listed:
            spans = []
            for x in [x for own in listed.values() for x in own]:
                marks = x["marks"]
                keep = [0]
                for m in marks[1:]:
                    if m - keep[-1] >= self.part_bytes:
                        keep.append(m)
                spans += [Span(f"{self.path}/{x['file']}", a, b) for a, b in zip(keep, [*keep[1:], None])]
            return spans or [Span("", 0, 0)]
        info = fs.get_file_info([top])[0]
        files = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(top, recursive=True))
        base = self.path[: len(self.path) - len(top)] if self.path.endswith(top) else ""
        return [Span(base + f.path, 0, None) for f in files if re.search(r"\.warc(\.gz)?$", f.path)] or [Span("", 0, 0)]

    def read(self, part: Span) -> Iterator[pa.RecordBatch]:
        if not part.path:
            return
        fs, path = file_system(part.path)
        rows: list[dict] = []
        held = 0
        with fs.open_input_file(path) as raw:
            # archives packed as a whole are read through; plain ones allow seeking
            stream = gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else io.BufferedReader(raw, 1 << 16)
            end = None if path.endswith(".gz") else raw.size()
            stream.seek(part.start)
            while part.end is None or stream.tell() < part.end:
                headers = read_headers(stream)
                if headers is None:
                    break
                row, size = columns_of(headers), next((v for k, v in headers.items() if k.lower() == "content-length"), None)
                if size is None:
                    raise ValueError(f"record without Content-Length: {row['record_id']}")
                size, wanted = int(size), self.wants(row)
                if wanted and self.want_payload and row["record_type"] != "revisit":
                    block = stream.read(size)
                    if len(block) < size:
                        raise ValueError("the archive ends within a record")
                    row["payload"] = payload_of(block) if "application/http" in headers.get("Content-Type", "") else block
                else:
                    _past(stream, size, end)
                    row["payload"] = None
                stream.seek(4, io.SEEK_CUR)  # the two line ends after a block
                if not wanted:
                    continue
                row["headers"] = list(headers.items())
                rows.append(row)
                held += len(row["payload"] or b"") + 500
                if held > BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [(c, pa.int64() if c == "payload_bytes" else pa.string()) for c in COLUMNS] + [("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in kinds], names=[c for c, _ in kinds])


@dataclass
class Part(WriterCommitMessage):
    file: str
    marks: list[int]


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool = False):
        self.path, self.overwrite = options["path"], overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        fs, top = file_system(self.path)
        fs.create_dir(top, recursive=True)
        name, marks, at = f"part-{uuid.uuid4().hex}.warc", [0], 0
        with fs.open_output_stream(f"{top}/{name}") as out:
            for batch in iterator:
                for i in range(batch.num_rows):
                    data = record({c: batch.column(c)[i].as_py() for c in (*COLUMNS, "payload")})
                    if at - marks[-1] >= BATCH_BYTES:
                        marks.append(at)
                    out.write(data)
                    at += len(data)
        if not at:
            fs.delete_file(f"{top}/{name}")
            return Part("", [])
        return Part(name, marks)

    def commit(self, messages: list[Part | None]) -> None:
        fs, top = file_system(self.path)
        fs.create_dir(top, recursive=True)
        older = indexes(fs, top) if self.overwrite else {}
        with fs.open_output_stream(f"{top}/{INDEX}-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps([{"file": m.file, "marks": m.marks} for m in messages if m and m.file]).encode())
        for index, files in older.items():
            fs.delete_file(index)
            for x in files:
                fs.delete_file(f"{top}/{x['file']}")

    def abort(self, messages: list[Part | None]) -> None:
        fs, top = file_system(self.path)
        for m in messages:
            if m and m.file:
                fs.delete_file(f"{top}/{m.file}")


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to this session."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def read_warc(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Records of an archive file or folder."""
    register(spark)
    return spark.read.format("warc").option("path", path).option("payload", str(payload).lower()).load()


def write_warc(records: DataFrame, path: str, mode: str = "append") -> None:
    """Write rows with the columns of ``SCHEMA`` (``headers`` is not used);
    ``mode`` is append or overwrite."""
    register(records.sparkSession)
    wanted = records.select(*[c for c in COLUMNS], "payload", F.lit(None).cast("map<string,string>").alias("headers"))
    wanted.select(*[x.split()[0] for x in SCHEMA.split(", ")]).write.format("warc").option("path", path).mode(mode).save()


#: Fixed by the rule: payloads below this size are always stored.
LEAST_BYTES = 100


def to_records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """WARC records of (page_id, url, html): equal payloads are stored once.

    Of equal payloads of at least ``LEAST_BYTES`` the smallest page_id is the
    response and the others revisit it; rows that repeat that smallest page_id
    are responses too.  Null html is an empty payload; a null page_id is never
    smallest, and where a payload has no other id all its rows are responses.
    Digests of payloads that occur twice or more are gathered with a partial
    aggregation and written, so the planner broadcasts them only when small,
    and otherwise joins with skewed digests split.  Other columns are ignored.
    """
    rows = pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"payload_bytes": F.octet_length("payload").cast("long"), "digest": F.sha2("payload", 256)})
    again = (rows.filter(F.col("payload_bytes") >= LEAST_BYTES).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1"))
    rows = rows.join(written(again.select("digest", "first"), "warc-repeats"), "digest", "left")
    revisit = F.expr(f"payload_bytes >= {LEAST_BYTES} and first is not null and not (page_id <=> first)")
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return rows.select(
        urn("page_id").alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
        F.when(revisit, urn("first")).alias("refers_to"), F.concat(F.lit("sha256:"), "digest").alias("payload_digest"), "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"))


def page_of(column: str):
    return F.regexp_extract(F.col(column), r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives of all pages, written and read back; payloads that are stored
    are measured as read, those of revisits are as their headers say."""
    path = scratch_path(spark, "warc")
    write_warc(to_records(table(spark, sf_dir, "pages")), path)
    back = read_warc(spark, path)
    stored = F.col("record_type") == "response"
    return back.select(
        page_of("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", page_of("refers_to").alias("refers_to"))


OP7 = """WITH p AS (
  SELECT page_id, sha256(coalesce(html, '')) AS d, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS first FROM p)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM f"""

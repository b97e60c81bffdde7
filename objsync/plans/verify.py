"""Object integrity checks (C9), multipart chunk plans (C10), md5 formats
(P23) and task completeness (A8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from objsync.config import PlanConfig
from objsync.functions import objects as O
from objsync.functions import routing as R
from objsync.functions import urls as U
from objsync.operators.inventory import inventory_by_key, listed, probe_join
from objsync.operators.projects import attach_projects
from objsync.operators.relational import chunk_id


def content_digest(objects: DataFrame, id_col: str, content_col: str) -> DataFrame:
    """Received bytes and md5 of delivered content, computed in Spark.

    ``received_size`` counts characters of a text column (bytes of a binary
    one); ``content_md5`` is the md5 of the UTF-8 bytes."""
    c = F.col(content_col)
    return objects.select(F.col(id_col).alias("id"), F.length(c).cast("bigint").alias("received_size"),
                          F.md5(c).alias("content_md5"))


def verify_objects(expected: DataFrame, stored: DataFrame, received: DataFrame) -> DataFrame:
    """First failing check per object, in the job's order:
    ``size_received`` (received bytes != manifest size), ``no_object`` (no
    stored object), ``size_stored`` (stored size != size), ``no_etag``,
    ``md5`` (content md5 != manifest md5); ``ok`` when all pass.

    ``expected``: ``(id, size, md5)``; ``stored``: ``(id, stored_size,
    etag)`` with a null ``stored_size`` for a missing object; ``received``:
    ``(id, received_size, content_md5)``.  Two key joins on the object id.
    """
    j = expected.join(stored, "id", "left").join(received, "id", "left")
    reason = (F.when(~F.coalesce(F.col("received_size") == F.col("size"), F.lit(False)), F.lit("size_received"))
              .when(F.col("stored_size").isNull(), F.lit("no_object"))
              .when(F.col("stored_size") != F.col("size"), F.lit("size_stored"))
              .when(F.col("etag").isNull(), F.lit("no_etag"))
              .when(~F.coalesce(F.col("content_md5") == F.col("md5"), F.lit(False)), F.lit("md5"))
              .otherwise(F.lit("ok")))
    return j.select("id", "size", "md5", "received_size", "stored_size", "etag", "content_md5",
                    reason.alias("result"), (reason == "ok").alias("passed"))


def gs_blob_checks(expected: DataFrame, blobs: DataFrame) -> DataFrame:
    """GS variants: ``exists_and_match`` (exists, same size, base64 md5 equal
    to the manifest md5) and ``resumable_copy_failed`` (exists, md5 differs).
    ``blobs``: ``(id, blob_size, md5_base64)``, missing rows = no blob."""
    j = expected.join(blobs.withColumn("_b", F.lit(True)), "id", "left")
    exists = F.coalesce(F.col("_b"), F.lit(False))
    hexmd5 = O.md5_hex_from_base64("md5_base64")
    return j.select("id", exists.alias("exists"),
                    (exists & F.coalesce((F.col("blob_size") == F.col("size")) & (hexmd5 == F.col("md5")),
                                         F.lit(False))).alias("exists_and_match"),
                    (exists & F.coalesce(hexmd5 != F.col("md5"), F.lit(False))).alias("resumable_copy_failed"))


def chunk_plan(objects: DataFrame, chunk_bytes: int, id_col: str = "id", size_col: str = "size") -> DataFrame:
    """One row per multipart part ``(id, size, part_number, start_byte,
    end_byte, part_size)``, inclusive ranges, part numbers from 1; none for size 0.
    A narrow (shuffle-free) generator."""
    if chunk_bytes <= 0:
        raise ValueError("chunk size must be positive")
    base = objects.select(F.col(id_col).alias("id"), F.col(size_col).alias("size"))
    parts = base.select("id", "size", F.posexplode(O.chunk_ranges(F.col("size"), chunk_bytes)).alias("pos", "r"))
    return parts.select("id", "size", (F.col("pos") + 1).cast("int").alias("part_number"),
                        F.col("r.start").alias("start_byte"), F.col("r.end").alias("end_byte"),
                        (F.col("r.end") - F.col("r.start") + 1).alias("part_size"))


def received_bytes(parts: DataFrame) -> DataFrame:
    """Bytes received per object = sum of its part sizes."""
    return parts.groupBy("id").agg(F.sum("part_size").cast("bigint").alias("received_size"))


def content_parts(objects: DataFrame, chunk_bytes: int, id_col: str, content_col: str) -> DataFrame:
    """C10 parts of a content column with the digests of their bytes: ``(id,
    part_number, part_size, part_md5)``, like ``file_parts`` of files."""
    content = F.col(content_col).cast("binary")
    base = objects.select(F.col(id_col).alias("id"), content.alias("_c"))
    parts = base.select("id", "_c", F.posexplode(O.chunk_ranges(F.octet_length("_c").cast("bigint"), chunk_bytes)).alias("pos", "r"))
    size = F.col("r.end") - F.col("r.start") + 1
    piece = F.substring(F.col("_c"), (F.col("r.start") + 1).cast("int"), size.cast("int"))
    return parts.select("id", (F.col("pos") + 1).cast("int").alias("part_number"), size.alias("part_size"), F.md5(piece).alias("part_md5"))


def combine_parts(parts: DataFrame, *by: str) -> DataFrame:
    """W5 + A7: parts that were digested apart, in part order: ``(by, parts,
    received_size, complete, multipart_etag)``.

    ``parts`` is the ordered list of ``(part_number, part_size, part_md5)``; a part that
    was delivered twice counts once (the later copy of equal ones is the same, of
    different ones the larger digest).  ``complete`` tells whether the numbers run
    from 1 without a gap.  The ETag of a multipart object is the MD5 of its
    parts' binary MD5s in order, a dash and their number.  An object has at
    most 10,000 parts, so its list is bounded.
    """
    once = parts.groupBy(*by, "part_number").agg(F.max(F.struct("part_size", "part_md5")).alias("p"))
    lists = once.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("part_number", "p.part_size", "p.part_md5"))).alias("parts"))
    digest = F.md5(F.unhex(F.array_join(F.transform("parts", lambda p: p["part_md5"]), "")))
    return lists.select(
        *by, "parts", F.aggregate("parts", F.lit(0).cast("bigint"), lambda n, p: n + p["part_size"]).alias("received_size"),
        (F.element_at("parts", -1)["part_number"] == F.size("parts")).alias("complete"),
        F.concat(digest, F.lit("-"), F.size("parts").cast("string")).alias("multipart_etag"))


def verify_parts(expected: DataFrame, parts: DataFrame, *by: str) -> DataFrame:
    """C9 for objects uploaded in parts: the job's checks in its order, with the
    stored ETag compared with the one the received parts make.  ``expected``:
    ``(by, size, stored_size, etag)``, nulls for a missing object; an object
    of no bytes has no parts and nothing to compare."""
    j = expected.join(combine_parts(parts, *by), list(by), "left")
    got = F.coalesce("received_size", F.lit(0))
    reason = (F.when(~F.coalesce((got == F.col("size")) & F.coalesce("complete", F.lit(True)), F.lit(False)), F.lit("size_received"))
              .when(F.col("stored_size").isNull(), F.lit("no_object"))
              .when(F.col("stored_size") != F.col("size"), F.lit("size_stored"))
              .when(F.col("etag").isNull(), F.lit("no_etag"))
              .when(F.col("multipart_etag").isNotNull() & (F.trim("etag", F.lit('"')) != F.col("multipart_etag")), F.lit("etag"))
              .otherwise(F.lit("ok")))
    return j.select(*by, "size", got.alias("received_size"), F.size(F.coalesce("parts", F.array())).alias("n_parts"), "multipart_etag",
                    reason.alias("result"), (reason == "ok").alias("passed"))


def group_complete(manifest: DataFrame, project_map: DataFrame, gs_inventory: DataFrame, cfg: PlanConfig,
                   chunk_rows: int = 100) -> DataFrame:
    """Per chunk of ``chunk_rows`` manifest rows (W7), whether every file
    of a known project is listed as ``gs_bucket/id/file_name``; rows of
    unknown projects are ignored."""
    m = attach_projects(manifest, project_map, cfg).withColumn("gs_bucket", R.gs_bucket("gs_bucket_prefix", "acl"))
    m = probe_join(m, inventory_by_key(gs_inventory, dedupe=cfg.dedupe_inventory), U.object_key("id", "file_name"))
    m = m.withColumn("chunk_id", chunk_id(chunk_rows))
    ok = ~F.col("known_project") | listed("objects", "gs_bucket")
    return m.groupBy("chunk_id").agg(F.count(F.lit(1)).alias("n_files"), F.bool_and(ok).alias("complete"))

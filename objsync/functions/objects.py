"""Object-level scalars: hashes, byte ranges, size units, text rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from objsync.functions._cache import cached_expr

from objsync import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cached_expr
def md5_base64(hex_md5) -> Column:
    """Hex md5 -> base64 of the 16 raw bytes (how GS reports ``md5Hash``)."""
    return F.base64(F.unhex(_col(hex_md5)))


@cached_expr
def md5_hex_from_base64(b64) -> Column:
    """base64 ``md5Hash`` -> lower-case hex, comparable with manifests."""
    return F.lower(F.hex(F.unbase64(_col(b64))))


@cached_expr
def chunk_ranges(size, chunk_bytes: int) -> Column:
    """Inclusive byte ranges ``(start, end)`` of ``chunk_bytes`` each.

    Empty for size 0 (``sequence(0, -1, d)`` would fail, hence the guard).
    """
    s = _col(size)
    return F.when(s > 0, F.transform(
        F.sequence(F.lit(0).cast("bigint"), s - 1, F.lit(chunk_bytes).cast("bigint")),
        lambda i: F.struct(i.alias("start"), F.least(i + F.lit(chunk_bytes - 1), s - 1).alias("end")),
    )).otherwise(F.array().cast("array<struct<start:bigint,end:bigint>>"))


@cached_expr
def gib(size) -> Column:
    """Bytes -> GiB as double."""
    return _col(size).cast("double") / F.lit(float(C.GIB))


@cached_expr
def py_bool_text(b) -> Column:
    """Python ``str(bool)``: ``True`` / ``False``."""
    return F.when(_col(b), F.lit("True")).otherwise(F.lit("False"))


@cached_expr
def py_text(c) -> Column:
    """Python ``'%s' % value`` for strings: null prints as ``None``."""
    return F.coalesce(_col(c).cast("string"), F.lit("None"))

"""Object keys, paths and URL parsing as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from objsync.functions._cache import cached_expr

from objsync import config as C

# scheme :// authority path ? query # fragment  (scheme is case-insensitive)
URL_PATTERN = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
# the same with scheme://authority as one group
HEAD_PATTERN = r"^(([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*))([^?#]*)(\?[^#]*)?(#.*)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cached_expr
def object_key(id_col="id", name_col="file_name") -> Column:
    """``id/file_name``."""
    return F.concat(_col(id_col), F.lit("/"), _col(name_col))


@cached_expr
def safe_name(name_col="file_name") -> Column:
    """P10: spaces replaced by ``_`` (GS object names)."""
    return F.replace(_col(name_col), F.lit(" "), F.lit("_"))


@cached_expr
def compact_acl(acl="acl") -> Column:
    """ACL text with all spaces removed."""
    return F.replace(_col(acl), F.lit(" "), F.lit(""))


@cached_expr
def provider_url(scheme: str, bucket, key) -> Column:
    """``scheme://bucket/key``."""
    return F.concat(F.lit(scheme + "://"), _col(bucket), F.lit("/"), _col(key))


@cached_expr
def url_scheme(url) -> Column:
    """Scheme, lower-cased like ``urlparse``; '' when there is none."""
    return F.lower(F.regexp_extract(_col(url), URL_PATTERN, 1))


@cached_expr
def url_netloc(url) -> Column:
    """Authority (bucket for s3:// and gs:// URLs); '' when none."""
    return F.regexp_extract(_col(url), URL_PATTERN, 2)


@cached_expr
def url_head(url) -> Column:
    """Scheme as written, ``://`` and authority in one match of the URL; '' when there is none."""
    return F.regexp_extract(_col(url), HEAD_PATTERN, 1)


@cached_expr
def url_path(url) -> Column:
    """Path including its leading ``/``; '' when none."""
    return F.regexp_extract(_col(url), URL_PATTERN, 3)


@cached_expr
def url_query(url) -> Column:
    """Query without the ``?``."""
    return F.regexp_replace(F.regexp_extract(_col(url), URL_PATTERN, 4), r"^\?", "")


@cached_expr
def url_fragment(url) -> Column:
    """Fragment without the ``#``."""
    return F.regexp_replace(F.regexp_extract(_col(url), URL_PATTERN, 5), r"^#", "")


@cached_expr
def structured_key(url) -> Column:
    """Path of a structured object without its first directory.

    ``gs://B/tcga/PAAD/x.bam`` -> ``PAAD/x.bam``.  Empty path segments are
    dropped (path join semantics); null when nothing is left.
    """
    parts = F.split(url_path(url), "/")
    tail = F.filter(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(1))), lambda x: x != "")
    return F.when(F.size(tail) > 0, F.array_join(tail, "/"))


@cached_expr
def uuid_tail_key(url) -> Column:
    """First ``uuid.*$`` match in a URL; null when there is none."""
    return F.nullif(F.regexp_extract(_col(url), C.UUID_TAIL_PATTERN, 0), F.lit(""))

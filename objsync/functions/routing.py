"""Bucket routing rules as Column expressions (whole-stage codegen friendly).

All functions take and return ``pyspark.sql.Column``; nothing here runs
Python per row.  The CASE order and the *substring* tests follow the
replication jobs exactly, including their asymmetries (see README).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from objsync.functions._cache import cached_expr

from objsync import config as C


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _drop_last(c: Column, n: int) -> Column:
    """Python ``s[:-n]``: all but the last ``n`` characters, '' when shorter."""
    return F.left(c, F.length(c) - F.lit(n))


@cached_expr
def is_open_2(acl) -> Column:
    """``acl in {"[u'open']", "['open']"}``; null acl is controlled."""
    return F.coalesce(_col(acl).isin(*C.OPEN_ACL_2), F.lit(False))


@cached_expr
def is_open_3(acl) -> Column:
    """``acl in {"[u'open']", "['open']", "*"}``; null acl is controlled."""
    return F.coalesce(_col(acl).isin(*C.OPEN_ACL_3), F.lit(False))


@cached_expr
def aws_bucket(aws_prefix, acl) -> Column:
    """Target AWS bucket of a file from its project's bucket prefix.

    Null when the prefix is null (unknown project).
    """
    p, open2, open3 = _col(aws_prefix), is_open_2(acl), is_open_3(acl)
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(p.contains("target"),
              F.when(open2, F.lit(C.TARGET_OPEN_BUCKET)).otherwise(F.lit(C.TARGET_CONTROLLED_BUCKET)))
        .when(p.contains("tcga"),
              F.when(open2, F.lit(C.TCGA_OPEN_BUCKET)).otherwise(F.lit(C.TCGA_CONTROLLED_BUCKET)))
        .when(p.isin(*C.POSTFIX_1_EXCEPTION),
              F.concat(p, F.when(open3, F.lit("-open")).otherwise(F.lit("-controlled"))))
        .when(p.isin(*C.POSTFIX_2_EXCEPTION),
              F.concat(p, F.when(open3, F.lit("-2-open")).otherwise(F.lit("-2-controlled"))))
        .otherwise(F.concat(p, F.when(open3, F.lit("-2-open")).otherwise(F.lit("-controlled"))))
    )


@cached_expr
def gs_bucket(gs_prefix, acl) -> Column:
    """Target GS bucket ``prefix-open`` / ``prefix-controlled``."""
    return F.concat(_col(gs_prefix),
                    F.when(is_open_3(acl), F.lit("-open")).otherwise(F.lit("-controlled")))


@cached_expr
def flip_account(bucket) -> Column:
    """P5: the same bucket in the other AWS account; null if no suffix matches."""
    b = _col(bucket)
    return (
        F.when(b.contains("-2-controlled"), F.concat(_drop_last(b, 12), F.lit("controlled")))
        .when(b.contains("-controlled"), F.concat(_drop_last(b, 10), F.lit("2-controlled")))
        .when(b.contains("-2-open"), F.concat(_drop_last(b, 6), F.lit("open")))
        .when(b.contains("-open"), F.concat(_drop_last(b, 4), F.lit("2-open")))
    )


@cached_expr
def aws_reversed_bucket(bucket) -> Column:
    """The bucket of the opposite ACL for an AWS target bucket."""
    b = _col(bucket)
    stem_c = F.when(b.contains("-2-controlled"), F.replace(b, F.lit("-2-controlled"), F.lit(""))) \
        .otherwise(F.replace(b, F.lit("-controlled"), F.lit("")))
    stem_o = F.when(b.contains("-2-open"), F.replace(b, F.lit("-2-open"), F.lit(""))) \
        .otherwise(F.replace(b, F.lit("-open"), F.lit("")))
    return (
        F.when(b.contains("target"),
               F.when(b.contains("open"), F.lit(C.TARGET_CONTROLLED_BUCKET))
               .otherwise(F.lit(C.TARGET_OPEN_BUCKET)))
        .when(b.contains("tcga"),
              F.when(b.contains("open"), F.concat(_drop_last(b, 4), F.lit("controlled")))
              .otherwise(F.concat(_drop_last(b, 10), F.lit("open"))))
        .when(b.contains("controlled"),
              F.when(stem_c.isin(*C.POSTFIX_1_EXCEPTION), F.concat(stem_c, F.lit("-open")))
              .otherwise(F.concat(stem_c, F.lit("-2-open"))))
        .when(b.contains("open"),
              F.when(stem_o.isin(*C.POSTFIX_2_EXCEPTION), F.concat(stem_o, F.lit("-2-controlled")))
              .otherwise(F.concat(stem_o, F.lit("-controlled"))))
    )


@cached_expr
def gs_reversed_bucket(bucket, acl) -> Column:
    """GS bucket of the opposite ACL; tests ``"open"`` as a substring of
    the ACL text (so ``*`` goes to ``-open`` here although P2 calls it open).
    Null when the ACL is null (the job fails on such rows)."""
    b, a = _col(bucket), _col(acl)
    return F.when(a.isNull(), F.lit(None).cast("string")) \
        .when(a.contains("open"), F.concat(_drop_last(b, 5), F.lit("-controlled"))) \
        .otherwise(F.concat(_drop_last(b, 11), F.lit("-open")))


@cached_expr
def aws_expected_buckets(aws_prefix) -> Column:
    """Array of AWS buckets listed for one project prefix."""
    p = _col(aws_prefix)
    open_sfx = F.when(p.isin(*C.POSTFIX_1_EXCEPTION), F.lit("open")).otherwise(F.lit("2-open"))
    ctl_sfx = F.when(p.isin(*C.POSTFIX_2_EXCEPTION), F.lit("2-controlled")).otherwise(F.lit("controlled"))
    return F.when(p.contains("target"),
                  F.array(F.lit(C.TARGET_OPEN_BUCKET), F.lit(C.TARGET_CONTROLLED_BUCKET))) \
        .otherwise(F.array(F.concat_ws("-", p, open_sfx), F.concat_ws("-", p, ctl_sfx)))


@cached_expr
def gs_expected_buckets(gs_prefix) -> Column:
    """Array of GS buckets listed for one project prefix."""
    p = _col(gs_prefix)
    return F.array(F.concat(p, F.lit("-open")), F.concat(p, F.lit("-controlled")))


@cached_expr
def bucket_project_stem(bucket) -> Column:
    """``b[:-5]`` when ``b`` ends in ``-open`` else ``b[:-11]``."""
    b = _col(bucket)
    return F.when(b.endswith("-open"), _drop_last(b, 5)).otherwise(_drop_last(b, 11))

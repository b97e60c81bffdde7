"""ACL text -> index ACL / authz arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from objsync.functions._cache import cached_expr

from objsync.functions.routing import is_open_2


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@cached_expr
def py_strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


@cached_expr
def acl_list(acl="acl") -> Column:
    """``['*']`` for open ACLs, else the items of the textual list.

    Null ACL text is treated as ''.
    """
    text = py_strip(F.coalesce(_col(acl), F.lit("")))
    inner = F.substr(text, F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))
    items = F.transform(
        F.split(inner, ",", -1),
        lambda x: F.replace(F.replace(py_strip(x), F.lit("u'"), F.lit("")), F.lit("'"), F.lit("")),
    )
    return F.when(is_open_2(acl), F.array(F.lit("*"))).otherwise(items)


@cached_expr
def acl_valid(acl="acl") -> Column:
    """Every parsed item starts with ``phs`` (open ACLs are valid)."""
    return is_open_2(acl) | F.forall(acl_list(acl), lambda x: x.startswith("phs"))


@cached_expr
def first_bad_ace(acl="acl") -> Column:
    """The first item failing P18, for the error message."""
    return F.element_at(F.filter(acl_list(acl), lambda x: ~x.startswith("phs")), 1)


@cached_expr
def authz_list(acl="acl", namespace: str = "") -> Column:
    """``['/open']`` or ``namespace + '/programs/' + ace`` per item."""
    return F.when(is_open_2(acl), F.array(F.lit("/open"))).otherwise(
        F.transform(acl_list(acl), lambda x: F.concat(F.lit(namespace + "/programs/"), x))
    )


@cached_expr
def same_set(a, b) -> Column:
    """P20: ``set(a) == set(b)``."""
    return F.sort_array(F.array_distinct(_col(a))) == F.sort_array(F.array_distinct(_col(b)))


@cached_expr
def bad_acl_message(acl="acl") -> Column:
    return F.concat(F.lit('Only "open" and "phs[...]" ACLs are allowed. Got ACL "'),
                    first_bad_ace(acl), F.lit('"'))


@cached_expr
def py_list_repr(arr) -> Column:
    """P25: Python ``repr`` of a list of strings: ``['a', 'b']``, ``[]``."""
    a = _col(arr)
    return F.when(F.size(a) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(a, "', '"), F.lit("']")))

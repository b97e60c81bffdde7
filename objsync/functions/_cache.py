"""Memoize Column factories called with plain names.

A ``Column`` built from column names is an unresolved expression, so the
same object can be reused in any DataFrame; caching it avoids rebuilding
large CASE trees through Py4J on every plan construction.
"""

from __future__ import annotations

import functools

_PRIMITIVES = (str, int, float, bool, type(None))


def cached_expr(fn):
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if all(isinstance(a, _PRIMITIVES) for a in args) and all(isinstance(v, _PRIMITIVES) for v in kwargs.values()):
            key = (args, tuple(sorted(kwargs.items())))
            hit = cache.get(key)
            if hit is None:
                hit = cache[key] = fn(*args, **kwargs)
            return hit
        return fn(*args, **kwargs)

    return wrapper

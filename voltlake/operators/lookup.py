"""Dictionary lookups.

Fixed dictionaries (17 zones, 21 production codes, ...) are expressed as map
literals: the lookup is an expression evaluated inside whole-stage codegen, so
no join and no shuffle is planned. A miss gives null, as a dict ``.map`` does.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_literal(v: object) -> str:
    """A Spark SQL literal for a Python str / int / float / None."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(pairs: Iterable[tuple[object, object]]) -> Column:
    """A literal map built in one expression (one JVM call, not one per entry)."""
    body = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in pairs)
    return F.expr(f"map({body})")


def lookup(key, pairs: Iterable[tuple[object, object]]) -> Column:
    """``mapping.get(key)`` as an expression; unknown keys give null."""
    key = F.col(key) if isinstance(key, str) else key
    return F.try_element_at(map_literal(pairs), key)


def lookup_or(key, pairs: Iterable[tuple[object, object]], default) -> Column:
    return F.coalesce(lookup(key, pairs), F.lit(default))

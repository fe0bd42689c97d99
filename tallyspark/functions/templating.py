"""Render ``str.format``-style templates as Spark ``concat`` or as SQL ``concat``.

A template is fixed text with named slots (``{name}``); the slot values are
Column expressions (Spark) or SQL expressions (oracle), supplied per use.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parts(template: str):
    for literal, field, _spec, _conv in string.Formatter().parse(template):
        yield literal, field


def render(template: str, fields: dict) -> Column:
    parts = []
    for literal, field in _parts(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            parts.append(fields[field])
    return F.concat(*parts) if len(parts) > 1 else (parts[0] if parts else F.lit(""))


def render_sql(template: str, fields: dict) -> str:
    parts = []
    for literal, field in _parts(template):
        if literal:
            parts.append("'" + literal.replace("'", "''") + "'")
        if field is not None:
            parts.append(f"({fields[field]})")
    return "concat(" + ", ".join(parts) + ")" if len(parts) > 1 else (parts[0] if parts else "''")


def pick(values, index_expr) -> Column:
    """``values[index % len(values)]`` for a non-negative integer Column."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(index_expr, F.lit(len(values))).cast("int") + 1)


def pick_sql(values, index_expr: str) -> str:
    arr = "[" + ", ".join("'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v) for v in values) + "]"
    return f"{arr}[({index_expr}) % {len(values)} + 1]"

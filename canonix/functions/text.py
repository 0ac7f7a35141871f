"""Scalar column helpers (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def canonical_string(c: Column) -> Column:
    """The comparison/display text of a value (C1, P7): a plain string cast.

    Integer features are cast to bigint by standardize first, so ``1`` never
    turns into ``1.0``; floats keep their ``.0``.
    """
    return c.cast("string")


def split_trim(c: Column, sep: str = ",") -> Column:
    """Split on a separator and strip each part."""
    return F.transform(F.split(c, _regex_escape(sep)), lambda x: F.regexp_replace(x, r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def _regex_escape(s: str) -> str:
    out = []
    for ch in s:
        out.append("\\" + ch if ch in r".^$*+?{}[]\|()" else ch)
    return "".join(out)


def dots_to_underscores(c: Column) -> Column:
    """``.`` -> ``_`` (C6), as used in the merge suffix."""
    return F.translate(c, ".", "_")


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.element_at(F.split(path, "/"), -1)


def base_name(path: Column) -> Column:
    """File name without its last extension (``a.tar.gz`` -> ``a.tar``; ``.env`` stays)."""
    name = file_name(path)
    return F.regexp_extract(name, r"^(.+?)(\.[^.]*)?$", 1)


def extension(path: Column) -> Column:
    """Last extension with its dot, ``''`` if none."""
    name = file_name(path)
    return F.regexp_extract(name, r"^.+(\.[^.]*)$", 1)


def ends_with_any(c: Column, suffixes: Sequence[str], ignore_case: bool = False) -> Column:
    """Suffix test against a list (C8), OR-ed."""
    target = F.lower(c) if ignore_case else c
    preds = [F.endswith(target, F.lit(s.lower() if ignore_case else s)) for s in suffixes]
    if not preds:
        return F.lit(False)
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out

"""Comparable forms of identifiers, as JVM-side expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
_NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


def fold_width(col: Column) -> Column:
    """Full-width ASCII and the ideographic space to their half-width forms."""
    return F.translate(col, _WIDE, _NARROW)


def comparable_id(col: Column) -> Column:
    """Ids that differ only in letter case, surrounding blanks or width become equal; blank and null become null."""
    bare = F.regexp_replace(F.lower(fold_width(col)), r"(?U)^\s+|\s+$", "")
    return F.when(bare != "", bare)

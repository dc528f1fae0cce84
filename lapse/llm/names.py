"""Columns by their literal names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> Column:
    """The top-level column of this very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(prefix: str, names: list[str]) -> str:
    """``prefix``, lengthened until no name (in any case) starts with it."""
    low = [n.lower() for n in names]
    while any(n.startswith(prefix.lower()) for n in low):
        prefix += "_"
    return prefix

"""Key look-ups in set form."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from tidegate.plans.skew import thinned


def require_columns(df: DataFrame | None, columns: Iterable[str], what: str) -> None:
    if df is None:
        raise ValueError(f"{what} is required")
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}")


def matching(table: DataFrame, keys: DataFrame | None, *on: str, trim: bool = False) -> DataFrame:
    """Rows of ``table`` whose key is in ``keys``; all rows if ``keys`` is None.

    ``trim`` strips blanks from the requested text, never from the stored one.
    """
    if keys is None:
        return table
    require_columns(keys, on, "keys")
    wanted = keys.select(*[(F.trim(c) if trim else F.col(c)).alias(c) for c in on])
    return table.join(thinned(wanted), list(on), "left_semi")


def beside(left: DataFrame, right: DataFrame, prefix: str, on, how: str = "inner") -> DataFrame:
    """Join and keep every column, giving a prefix to those of ``right`` whose name ``left`` already uses.

    ``on`` maps columns of ``left`` to columns of ``right``.
    """
    taken = set(left.columns)
    renamed = right.select(*[F.col(c).alias(f"{prefix}{c}" if c in taken else c) for c in right.columns])
    names = dict(zip(right.columns, renamed.columns))
    condition = None
    for a, b in on.items():
        part = left[a] == renamed[names[b]]
        condition = part if condition is None else condition & part
    return left.join(renamed, condition, how)

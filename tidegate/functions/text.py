"""Text helpers: names, paths and hand-entered option values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Option texts that people enter to say "nothing".
EMPTY_WORDS = ["", "none", "n/a", "na"]


def blank_to_null(text: Column) -> Column:
    """NULL for text that means "not set", else the text as it is."""
    return F.when(~F.lower(F.trim(text)).isin(EMPTY_WORDS), text)


def is_set(text: Column) -> Column:
    return F.coalesce(text, F.lit("")) != ""


def stage_table_name(stage_name: Column, file_id: Column) -> Column:
    """Stage name and the last seven digits of the zero-padded file id, in capitals.

    Ids of more than seven digits share names, so this is a label, never a key.
    """
    digits = F.right(F.concat(F.lit("0000000"), file_id.cast("string")), F.lit(7))
    return F.upper(F.concat(stage_name, F.lit("_"), digits))


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent_directory(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def landing_directory(path: Column, root: str = "/Files") -> Column:
    """Directory of a landed file, counted from the first landing root in its path."""
    return F.concat(F.lit(root), parent_directory(F.regexp_replace(path, f"^.*?{root}", "")))

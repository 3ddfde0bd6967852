"""File and column names."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How a column name is made safe for table formats.
REPLACED = {" ": "_"}
DROPPED = "()=."


def safe_name(name: str) -> str:
    table = str.maketrans(REPLACED | dict.fromkeys(DROPPED, ""))
    return name.translate(table).strip()


def sanitize_columns(df: DataFrame) -> DataFrame:
    """Rename all columns to safe names; two names becoming one is an error."""
    safe = [safe_name(name) for name in df.columns]
    clashes = sorted({name for name in safe if safe.count(name) > 1})
    if clashes:
        raise ValueError(f"column names collide after cleaning: {clashes}")
    return df.toDF(*safe)


def file_year(path: Column, source: str | None = None) -> Column:
    """Year of a ``YYYY_MM_DD_<source>.json`` file, null for other names.

    Without ``source`` any source name counts.
    """
    # Fixed value: pattern of a dated file name.
    name = "[^/]+" if source is None else re.escape(source)
    pattern = rf"(\d{{4}})_\d{{2}}_\d{{2}}_{name}\.json"
    return F.regexp_extract(path, pattern, 1).try_cast("int")


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)

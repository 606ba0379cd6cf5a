"""Delimited text with a fixed multi-character separator and no quoting."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starfit.functions import to_double, to_integer

# The separator and the field order of the two input files.
SEPARATOR = "::"
RATING_FIELDS = (
    ("userId", "int"),
    ("movieId", "int"),
    ("rating", "double"),
    ("timestamp", "int"),
)
MOVIE_FIELDS = (
    ("movieId", "int"),
    ("title", "string"),
    ("genres", "string"),
)

REJECT_REASON = "reason"
RAW_LINE = "line"


@dataclass(frozen=True)
class Parsed:
    """Typed rows, and the lines that gave none."""

    good: DataFrame
    rejects: DataFrame


def typed(text: Column, type_name: str) -> Column:
    if type_name in ("int", "bigint"):
        return to_integer(text, type_name)
    if type_name == "double":
        return to_double(text)
    if type_name == "string":
        return text
    raise ValueError(f"no reader for a field of type {type_name}")


def parse_lines(
    lines: DataFrame,
    fields: Sequence[tuple[str, str]],
    separator: str = SEPARATOR,
    column: str = "value",
) -> Parsed:
    """Split each line by position and type its fields.

    A short line has empty text in its missing fields. A line with a number that cannot
    be read, or with more fields than named, goes to the rejects with the reason.
    """
    parts = F.split(F.col(column), re.escape(separator), -1)
    split = lines.select(F.col(column).alias(RAW_LINE), parts.alias("_parts"))
    texts = {name: F.coalesce(F.get("_parts", F.lit(i)), F.lit("")) for i, (name, _) in enumerate(fields)}
    values = {name: typed(texts[name], type_name) for name, type_name in fields}
    reason = F.when(F.size("_parts") > len(fields), F.lit("too many fields"))
    for name, type_name in fields:
        if type_name != "string":
            reason = reason.when(values[name].isNull(), F.lit(f"no number in {name}"))
    good = split.filter(reason.isNull()).select(*[values[name].alias(name) for name, _ in fields])
    rejects = split.filter(reason.isNotNull()).select(RAW_LINE, reason.alias(REJECT_REASON))
    return Parsed(good, rejects)


def read_delimited(
    spark: SparkSession,
    path: str,
    fields: Sequence[tuple[str, str]],
    separator: str = SEPARATOR,
) -> Parsed:
    """Read text files under ``path``. Nothing is inferred: ``fields`` names and types them."""
    return parse_lines(spark.read.text(path), fields, separator)


def as_lines(frame: DataFrame, columns: Sequence[str], separator: str = SEPARATOR) -> DataFrame:
    """One delimited line per row; a missing value is written as empty text."""
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    return frame.select(F.concat_ws(separator, *texts).alias("value"))


def write_delimited(
    frame: DataFrame, path: str, columns: Sequence[str], separator: str = SEPARATOR
) -> None:
    as_lines(frame, columns, separator).write.text(path)

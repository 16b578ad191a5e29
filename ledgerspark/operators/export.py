"""Tables as files that other systems load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parsing import copy_text


def copy_lines(rows: DataFrame) -> DataFrame:
    """A line of COPY text for each row: fields between tabs, in the order of the columns."""
    kinds = {T.StringType: "text", T.BooleanType: "boolean"}
    return rows.select(F.concat_ws("\t", *[copy_text(F.col(f"`{f.name}`"), kinds.get(type(f.dataType), "other")) for f in rows.schema]).alias("value"))


def export_copy(rows: DataFrame, path: str) -> None:
    copy_lines(rows).write.option("lineSep", "\n").text(path)

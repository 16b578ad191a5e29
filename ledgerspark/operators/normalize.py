"""Lines to typed rows, split into valid ones and quarantined ones with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..model import DEFAULTS, LAYOUTS, Field


def normalized(lines: DataFrame, layout: tuple[Field, ...], defaults: dict[str, str] | None = None, line: str = "value", types: bool = True) -> DataFrame:
    """lines with a typed column for each field, and error: null, or the first check that fails.

    The order of the checks: number of fields, required fields in the layout's
    order, values.  Codes that are blank are replaced before.
    """
    defaults = defaults or {}
    rows = P.once(lines, __fields=P.split_line(F.col(line)))
    fitted, count_error = P.fit_fields(F.col("__fields"), len(layout))
    rows = P.once(rows, __fields=P.texts(fitted, F.col(line)), __error=count_error)
    values, missing, wrong = {}, [], {}
    for i, f in enumerate(layout):
        raw = F.col("__fields")[i]
        value, error = P.PARSERS[f.kind](raw, trimmed=True)
        if f.name in defaults:
            value = F.coalesce(value, F.lit(defaults[f.name]))
        values[f.name], wrong[f"__wrong{i}"] = value, error
        if f.required and f.name not in defaults:
            missing.append(F.when(raw.isNull(), F.lit(f"Missing required value for {f.name}.")))
    others = [c for c in lines.columns if c not in values]
    rows = rows.select(*others, "__fields", "__error", *[v.alias(k) for k, v in (values | wrong).items()])
    return P.once(rows, error=F.coalesce("__error", *missing, *wrong)).select(*others, *values, "error")


def dataset_rows(lines: DataFrame, dataset: str) -> DataFrame:
    """normalized() for one of the datasets; blank lines don't count."""
    return normalized(lines.filter(P.utrim(F.col("value")) != ""), LAYOUTS[dataset], DEFAULTS.get(dataset))


def valid(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("error").isNull()).drop("error")


def quarantined(rows: DataFrame, dataset: str, file_path: Column, row_number: Column, layout: tuple[Field, ...] | None = None, id_: Column | None = None, offset: Column | None = None) -> DataFrame:
    """The rows with an error, as quarantine records; with an id and the offset behind the line where given."""
    ids = [] if id_ is None else [id_.cast("long").alias("id")]
    at = [] if offset is None else [offset.cast("long").alias("checkpoint_offset")]
    kind = P.classify(F.col("error"))
    payload = F.to_json(F.struct(*[F.col(f.name) for f in layout or LAYOUTS[dataset]]), {"ignoreNullFields": "false"})
    from_parser = F.col("error").startswith("Unexpected field count") | F.col("error").startswith("Missing required")
    return rows.filter(F.col("error").isNotNull()).select(
        *ids, F.lit(dataset).alias("dataset"), file_path.alias("file_path"), row_number.cast("long").alias("row_number"), *at,
        F.when(from_parser, "VALIDATION_ERROR").otherwise("QUARANTINED_ROW").alias("error_code"), kind["category"].alias("error_category"),
        F.lit(None).cast("string").alias("error_stage"), F.col("error").alias("error_message"), F.col("value").alias("raw_line"),
        F.when(~from_parser, payload).alias("parsed_payload"), F.lit(0).alias("retry_count"), kind["retryable"].alias("can_retry_later"),
    )

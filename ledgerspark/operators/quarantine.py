"""Questions to the quarantine table: statistics, pages, single records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import schema


def selected(rows: DataFrame, dataset: str | None = None, category: str | None = None, stage: str | None = None, retryable: bool = False, terminal: bool = False) -> DataFrame:
    if retryable and terminal:
        raise ValueError("retryable and terminal exclude each other")
    if dataset is not None:
        rows = rows.filter(F.col("dataset") == dataset)
    if category is not None:
        rows = rows.filter(F.coalesce("error_category", F.lit("")) == category)
    if stage is not None:
        rows = rows.filter(F.coalesce("error_stage", F.lit("")) == stage)
    if retryable or terminal:
        rows = rows.filter(F.col("can_retry_later") == retryable)
    return rows


def totals(rows: DataFrame, **filters) -> DataFrame:
    return selected(rows, **filters).agg(F.count(F.lit(1)).alias("total"), F.count_if("can_retry_later").alias("retryable"), F.count_if(~F.col("can_retry_later")).alias("terminal"))


def counts(rows: DataFrame, by: str, **filters) -> DataFrame:
    """How many by dataset, error_category or error_stage; most first."""
    key = F.col(by) if by == "dataset" else F.coalesce(F.col(by), F.lit("unknown"))
    return selected(rows, **filters).groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "key")


def page(rows: DataFrame, limit: int = 20, after_id: int | None = None, **filters) -> DataFrame:
    """The next records by id, without the raw line and the payload."""
    if limit <= 0 or (after_id is not None and after_id < 0):
        raise ValueError("limit must be positive and after_id not negative")
    rows = selected(rows, **filters)
    if after_id is not None:
        rows = rows.filter(F.col("id") > after_id)
    return rows.drop("raw_line", "parsed_payload").orderBy("id").limit(limit)


def record(rows: DataFrame, id_: int) -> DataFrame:
    if id_ <= 0:
        raise ValueError("id must be positive")
    return rows.filter(F.col("id") == id_)


def shown(rows: DataFrame, id_: int):
    found = record(rows, id_).first()
    if found is None:
        raise LookupError(f"no quarantined row {id_}")
    return found


def payload(spark: SparkSession, text: str | None, dataset: str) -> dict | None:
    """The typed fields of a record's JSON."""
    if text is None:
        return None
    found = spark.createDataFrame([(text,)], "payload string").select(F.from_json("payload", schema(dataset)).alias("p")).first().p
    return found.asDict() if found is not None else None


def quarantined_rows(quarantine: DataFrame, plan_files: DataFrame, plan_id: int) -> DataFrame:
    """Different (file_path, row_number) of a plan's files in quarantine, counted by dataset."""
    mine = plan_files.filter(F.col("plan_id") == plan_id).select("dataset", "file_path")
    return quarantine.filter("row_number IS NOT NULL").join(mine, ["dataset", "file_path"]).groupBy("dataset").agg(F.countDistinct("file_path", "row_number").alias("rows"))

"""From staged rows to final tables: derived keys, dedupe, chunks, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import parsing as P
from ..model import KEYS, LAYOUTS, REFERENCES
from .tables import first_wins, last_wins, missing_codes, upsert


def keyed(rows: DataFrame, dataset: str) -> DataFrame:
    """With the key that the final table has and the staged one lacks."""
    if dataset == "establishments":
        return rows.withColumn("cnpj_full", P.cnpj_full(F.col("cnpj_root"), F.col("cnpj_order"), F.col("cnpj_check_digits")))
    if dataset == "partners":
        names = [f.name for f in LAYOUTS["partners"]]
        return rows.withColumn("partner_dedupe_key", P.dedupe_key([F.col(n) for n in names], names.index("entry_date")))
    return rows


def deduped(rows: DataFrame, dataset: str) -> DataFrame:
    """The last staged row a key; of partners, whose key covers all columns, the first."""
    return (first_wins if dataset == "partners" else last_wins)(rows, KEYS[dataset], "staging_id")


def flags_allowed(column: str) -> Column:
    return F.col(column).isNull() | F.col(column).isin("S", "N", "")


def flag_violations(rows: DataFrame) -> DataFrame:
    return rows.filter(~(flags_allowed("simples_option_flag") & flags_allowed("mei_option_flag")))


def chunk(rows: DataFrame, after: int, size: int, column: str = "staging_id") -> DataFrame:
    """The next rows by id."""
    return rows.filter(F.col(column) > after).orderBy(column).limit(size)


def state(rows: DataFrame, column: str = "staging_id") -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.max(column), F.lit(0)).cast("long").alias("last_id"))


def with_ids(rows: DataFrame, column: str, after: int) -> DataFrame:
    """Rows with ids that rise from after, by partition: rows are counted there, never sorted together."""
    own = Window.partitionBy("__part").orderBy("__at")
    rows = rows.withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    parts = rows.groupBy("__part").count().withColumn("__before", F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    rows = rows.join(F.broadcast(parts.select("__part", "__before")), "__part")
    return rows.withColumn(column, (F.row_number().over(own) + F.col("__before") + after).cast("long")).drop("__part", "__at", "__before")


def placeholders(rows: DataFrame, dataset: str, lookups: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """For each lookup the rows to add: placeholders for codes of any column that it lacks."""
    columns: dict[str, list[str]] = {}
    for column, table in REFERENCES.get(dataset, {}).items():
        if column in rows.columns:
            columns.setdefault(table, []).append(column)
    out = {}
    for table, own in columns.items():
        codes = rows.select(F.explode(F.array(*own)).alias("code"))
        out[table] = missing_codes(codes, "code", lookups[table]).select("code", P.placeholder(table, F.col("code")).alias("description"))
    return out


def checked(rows: DataFrame, dataset: str) -> DataFrame:
    """The rows; a flag outside its values fails the job."""
    if dataset == "simples_options":
        allowed = flags_allowed("simples_option_flag") & flags_allowed("mei_option_flag")
        rows = rows.filter(F.assert_true(allowed, F.lit("violates check constraint on flags")).isNull())
    return rows


def merged(rows: DataFrame, target: DataFrame, dataset: str) -> DataFrame:
    """The final table after keyed rows, some of which may have the same key."""
    return upsert(target, checked(deduped(rows, dataset), dataset), KEYS[dataset])


def materialized(staged: DataFrame, target: DataFrame, dataset: str) -> DataFrame:
    """The final table after all staged rows."""
    return merged(keyed(staged, dataset), target, dataset)

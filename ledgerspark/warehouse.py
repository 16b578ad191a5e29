"""A folder of tables: final, staged, lookup and control tables by name."""

from __future__ import annotations

import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .model import KEYS, LOOKUPS, REFERENCES, SEEDS, STAGED, schema
from .operators.tables import Control, Store, Table
from .errors import ValidationError

CODES = T.StructType([T.StructField("code", T.StringType()), T.StructField("description", T.StringType())])

_CONTROL = {
    "import_plans": "id bigint, source_fingerprint string, validated_path string, target_database string, batch_size int, datasets string, status string, load_status string, materialization_status string, last_error string, created_at timestamp, updated_at timestamp, last_used_at timestamp",
    "import_plan_files": "plan_id bigint, dataset string, dataset_index int, file_index int, file_path string, display_path string, file_size bigint, file_mtime double, rows bigint, batches bigint, updated_at timestamp",
    "import_checkpoints": "dataset string, file_path string, file_size bigint, file_mtime double, byte_offset bigint, rows_committed bigint, status string, last_error string, updated_at timestamp",
    "import_materialization_checkpoints": "plan_id bigint, dataset string, status string, last_staging_id bigint, chunks_completed bigint, rows_materialized bigint, staged_rows bigint, staged_max_id bigint, lookups_status string, lookups_rows bigint, lookups_max_id bigint, lookups_added bigint, last_error string, updated_at timestamp",
}
_LARGE = {"import_quarantine": "id bigint, dataset string, file_path string, row_number bigint, checkpoint_offset bigint, error_code string, error_category string, error_stage string, error_message string, raw_line string, parsed_payload string, retry_count int, can_retry_later boolean, created_at timestamp"}


def schema_of(name: str) -> T.StructType:
    if name in _CONTROL or name in _LARGE:
        return T._parse_datatype_string((_CONTROL | _LARGE)[name])
    if name in LOOKUPS or name in SEEDS:
        return CODES
    if name.startswith("staging_"):
        return T.StructType([T.StructField("staging_id", T.LongType()), *schema(name.removeprefix("staging_")).fields])
    if name.startswith("merging_"):  # what a materialisation has taken in and not yet merged
        rows = schema(name.removeprefix("merging_")).fields
        key = [T.StructField(k, T.StringType()) for k in KEYS[name.removeprefix("merging_")] if k not in [f.name for f in rows]]
        return T.StructType([T.StructField("staging_id", T.LongType()), *rows, *key])
    if name in STAGED:
        key = [T.StructField(k, T.StringType()) for k in KEYS[name] if k not in schema(name).names]
        times = [T.StructField(c, T.TimestampType()) for c in ("created_at", "updated_at")]
        return T.StructType([*schema(name).fields, *key, *times])
    raise ValidationError(f"no table {name}")


NAMES = (*STAGED, *LOOKUPS, *SEEDS, *[f"staging_{d}" for d in STAGED], *[f"merging_{d}" for d in STAGED], *_CONTROL, *_LARGE)


def label(path: str) -> str:
    """host/last part of the path, without user, password and folders."""
    parsed = urlparse(path)
    return f"{parsed.hostname or 'local'}/{os.path.basename(parsed.path.rstrip('/')) or 'warehouse'}"


class Warehouse:
    def __init__(self, spark: SparkSession, path: str):
        if not path:
            raise ValidationError("no warehouse path is given or configured")
        self.spark, self.path = spark, path.rstrip("/")
        self.store = Store(spark, path)

    def table(self, name: str) -> Table:
        return (Control if name in _CONTROL else Table)(self.store, name, schema_of(name))

    def control(self, name: str) -> Control:
        return Control(self.store, name, schema_of(name))

    def transaction(self):
        """Changes of several tables that become visible together."""
        return self.store.transaction()

    def read(self, name: str) -> DataFrame:
        rows = self.table(name).read()
        if name in SEEDS and not self.table(name).parts():
            return self.spark.createDataFrame(list(SEEDS[name].items()), CODES)
        return rows

    def catalog(self) -> DataFrame:
        """(table_name, column_name, data_type) of what is stored."""
        found = [(n, f.name, f.dataType.simpleString()) for n in NAMES for f in (self.table(n).stored_schema() or [] if n not in _CONTROL else self.table(n).schema if self.table(n).parts() else [])]
        return self.spark.createDataFrame(found, "table_name string, column_name string, data_type string")

    def ensure_shape(self, name: str, hint: str = "") -> None:
        """Fails if a stored table lacks columns that are needed."""
        table = self.table(name)
        stored = None if name in _CONTROL else table.stored_schema()
        missing = [f.name for f in table.schema if stored is not None and f.name not in stored.names]
        if missing:
            raise ValidationError(f"{hint} Table {name} lacks columns: {', '.join(missing)}.".strip())

    def capabilities(self) -> dict[str, bool]:
        """Which derived keys the final tables hold, and whether coded columns refer to lookups that are stored."""
        columns = self.catalog()
        refers = self.spark.createDataFrame([(d, c, t) for d, of in REFERENCES.items() for c, t in of.items()], "table_name string, column_name string, target string")
        stored = columns.select(F.col("table_name").alias("target")).distinct()
        held = lambda t, c: not columns.filter((F.col("table_name") == t) & (F.col("column_name") == c)).isEmpty()
        return {
            "establishments.cnpj_full": held("establishments", "cnpj_full"), "partners.partner_dedupe_key": held("partners", "partner_dedupe_key"),
            "requires_lookup_reconciliation": not refers.join(columns, ["table_name", "column_name"]).join(stored, "target").isEmpty(),
        }

    def ping(self) -> None:
        """Fails unless Spark answers and the warehouse's folder can be made."""
        self.spark.sql("SELECT 1").collect()
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(folder):
            raise OSError(f"{self.path} can't be made")

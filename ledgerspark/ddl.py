"""DDL for Spark tables. Keys and checks are comments: file tables don't enforce them, materialisation does."""

from __future__ import annotations

from .errors import ValidationError
from .model import KEYS, LAYOUTS, SEEDS, STAGED, Field

TYPES = {"text": "STRING", "integer": "BIGINT", "numeric": "DECIMAL(18,2)", "date": "DATE", "boolean": "BOOLEAN"}
PROFILES = {"full": ("domain", "final", "control", "staging", "seeds", "indexes"), "final": ("domain", "final", "control", "seeds", "indexes"), "staging": ("staging",)}

# Other names of the profiles.
ALIASES = {
    "all": "full", "combined": "full", "full": "full",
    "final": "final", "final-load": "final", "load": "final", "minimal": "final", "operational": "final", "production": "final",
    "stage": "staging", "staging": "staging",
}

#: Columns that questions select by. File tables have no indexes; rows sorted by these make the statistics of Parquet do.
SORTED = {
    "establishments": ("cnpj_root",), "partners": ("cnpj_root",), "import_plans": ("status", "load_status", "materialization_status"), "import_plan_files": ("plan_id", "dataset"),
    "import_checkpoints": ("status", "dataset"), "import_materialization_checkpoints": ("status", "plan_id", "dataset"), "import_quarantine": ("dataset", "file_path", "error_category", "can_retry_later"),
}

CONTROL = {
    "import_plans": "id BIGINT, source_fingerprint STRING, validated_path STRING, target_database STRING, batch_size INT, execution_order ARRAY<STRING>, status STRING, load_status STRING, materialization_status STRING, total_files BIGINT, total_rows BIGINT, total_batches BIGINT, created_at TIMESTAMP, updated_at TIMESTAMP, last_used_at TIMESTAMP",
    "import_plan_files": "plan_id BIGINT, dataset STRING, dataset_index INT, file_index INT, file_path STRING, file_size BIGINT, file_mtime TIMESTAMP, rows BIGINT, batches BIGINT",
    "import_checkpoints": "id BIGINT, dataset STRING, file_path STRING, file_size BIGINT, file_mtime TIMESTAMP, byte_offset BIGINT, rows_committed BIGINT, status STRING, last_error STRING, updated_at TIMESTAMP",
    "import_materialization_checkpoints": "plan_id BIGINT, dataset STRING, status STRING, last_staging_id BIGINT, chunks_completed BIGINT, rows_materialized BIGINT, staged_rows BIGINT, staged_max_id BIGINT, last_error STRING, updated_at TIMESTAMP",
    "import_quarantine": "id BIGINT, dataset STRING, file_path STRING, row_number BIGINT, checkpoint_offset BIGINT, error_code STRING, error_category STRING, error_stage STRING, error_message STRING, raw_line STRING, parsed_payload STRING, sanitizations_applied STRING, retry_count INT, can_retry_later BOOLEAN, created_at TIMESTAMP",
}


def _table(name: str, fields: tuple[Field, ...], before: str = "", after: str = "", key: tuple[str, ...] = ()) -> str:
    columns = [f"  {f.name} {TYPES[f.kind]}" + (" NOT NULL" if f.required else "") for f in fields]
    columns = ([f"  {before}"] if before else []) + columns + ([f"  {after}"] if after else [])
    note = f" COMMENT 'key: {', '.join(key)}'" if key else ""
    return f"CREATE TABLE IF NOT EXISTS {name} (\n" + ",\n".join(columns) + f"\n) USING parquet{note};"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def profile_of(name: str | None) -> str:
    """The profile of that name or alias; full without one."""
    plain = (name or "").strip().lower()
    if plain and plain not in ALIASES:
        raise ValidationError(f"no schema profile {name}; full, final and staging are known, and {', '.join(k for k in ALIASES if k not in PROFILES)}")
    return ALIASES[plain] if plain else "full"


def file_name(profile: str, name: str | None = None) -> str:
    """The file for a profile's DDL, with .sql at the end."""
    plain = (name or "").strip() or ("schema" if profile == "full" else f"schema-{profile}")
    return plain if plain.lower().endswith(".sql") else f"{plain}.sql"


def generate(profile: str | None = "full") -> str:
    profile = profile_of(profile)
    out, parts = [f"-- Tables of the registry. Profile: {profile}"], PROFILES[profile]
    code = (Field("code", "text", True), Field("description", "text", True))
    if "domain" in parts:
        out += [_table(x, code, key=("code",)) for x in (*[k for k in LAYOUTS if k not in STAGED], *SEEDS)]
    if "final" in parts:
        own = {"establishments": "cnpj_full STRING NOT NULL, ", "partners": "partner_dedupe_key STRING NOT NULL, "}
        out += [_table(x, LAYOUTS[x], after=own.get(x, "") + "created_at TIMESTAMP, updated_at TIMESTAMP", key=KEYS[x]) for x in STAGED]
    if "staging" in parts:
        out += [_table(f"staging_{x}", LAYOUTS[x], before="staging_id BIGINT NOT NULL") for x in STAGED]
    if "control" in parts:
        out += [f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet;" for name, columns in CONTROL.items()]
    if "seeds" in parts:
        out += [f"INSERT INTO {name} VALUES " + ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in rows.items()) + ";" for name, rows in SEEDS.items()]
    if "indexes" in parts:
        out.append("\n".join(f"-- select {name} by {', '.join(columns)}: keep rows sorted by {columns[0]}" for name, columns in SORTED.items()))
    return "\n\n".join(out) + "\n"

"""The engine's operators as queries over the synthetic tables, each with equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import parsing as P
from .model import DEFAULTS, LAYOUTS, REFERENCES, Field, schema
from .operators import materialize as M
from .operators import normalize as N
from .operators import quarantine as Q
from .operators import tables as TB
from .operators.export import copy_lines
from .plans import planning as PL
from .sources import files as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def company_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of companies from orders, some of them wrong by rule."""
    return table(spark, sf, "orders").select("o_orderkey", F.expr("""concat(
        lpad(cast(o_orderkey as string), 8, '0'), ';', if(o_orderkey % 11 = 0, '  ', o_orderpriority), ';', o_orderstatus, ';', o_custkey, ';',
        if(o_orderkey % 13 = 0, 'abc', concat(cast(round(o_totalprice * 100) as bigint) div 100, ',', lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as string), 2, '0'))), ';',
        if(o_orderkey % 3 = 0, '', '"03"'), ';', case when o_orderkey % 17 = 0 then ';x' when o_orderkey % 19 = 0 then ';; ' else '' end)""").alias("value"))  # fmt: skip


COMPANY = """
    SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS cnpj_root, CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS company_name, o_orderstatus AS legal_nature_code,
        CAST(o_custkey AS VARCHAR) AS responsible_qualification_code, CASE WHEN o_orderkey % 13 <> 0 THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) / CAST(100 AS DECIMAL(3,0)) AS DECIMAL(18,2)) END AS share_capital,
        CASE WHEN o_orderkey % 3 = 0 THEN '00' ELSE '03' END AS company_size_code,
        CASE WHEN o_orderkey % 17 = 0 THEN 'Unexpected field count: 8 instead of 7.' WHEN o_orderkey % 11 = 0 THEN 'Missing required value for company_name.' WHEN o_orderkey % 13 = 0 THEN 'Invalid numeric value: abc' END AS error
    FROM orders"""


def company_rows(spark: SparkSession, sf: str) -> DataFrame:
    return N.normalized(company_lines(spark, sf), LAYOUTS["companies"], DEFAULTS["companies"])


def company_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    path = F.concat(F.lit("part-"), (F.col("o_orderkey") % 4).cast("string"))
    rows = N.quarantined(company_rows(spark, sf), "companies", path, F.col("o_orderkey"))
    name = F.when(F.col("row_number") % 2 == 0, "companies").otherwise("partners")
    return rows.withColumns({"id": F.col("row_number"), "dataset": name})


QUARANTINE = f"""
    SELECT o_orderkey AS id, o_orderkey AS row_number, 'part-' || CAST(o_orderkey % 4 AS VARCHAR) AS file_path, CASE WHEN o_orderkey % 2 = 0 THEN 'companies' ELSE 'partners' END AS dataset,
        error AS error_message, CASE WHEN contains(lower(error), 'field count') THEN 'invalid_field_count' ELSE 'unknown' END AS error_category, contains(lower(error), 'field count') AS can_retry_later
    FROM ({COMPANY}) WHERE error IS NOT NULL"""


@query("""SELECT o_orderkey, o_orderpriority || ';"' || o_orderstatus AS f1, 'a' || CAST(o_custkey AS VARCHAR) || ';b' AS f2, '\\' || o_orderstatus AS f3, CAST(4 AS BIGINT) AS n FROM orders""")
def parse_lines(spark, sf):
    """Quoted semicolons, doubled quotes, quotes within a field, backslashes, an empty last field."""
    line = F.expr("""concat('"', o_orderpriority, ';""', o_orderstatus, '";a', o_custkey, '";"b;\\\\', o_orderstatus, ';')""")
    fields = P.split_line(F.col("line"))
    return table(spark, sf, "orders").select("o_orderkey", line.alias("line")).select("o_orderkey", fields.alias("f")).select("o_orderkey", F.col("f")[0].alias("f1"), F.col("f")[1].alias("f2"), F.col("f")[2].alias("f3"), F.size("f").cast("long").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(4 AS BIGINT) END AS n, CASE WHEN o_orderkey % 3 = 0 THEN 'Unexpected field count: 5 instead of 4.' END AS error,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 3 = 1 THEN '' ELSE 'd' END AS last FROM orders""")
def field_count_norm(spark, sf):
    line = F.expr("case o_orderkey % 3 when 0 then 'a;b;c;d;e' when 1 then 'a;b;c' else 'a;b;c;d;; ;' end")
    fields, error = P.fit_fields(P.split_line(line), 4)
    rows = table(spark, sf, "orders").select("o_orderkey", fields.alias("f"), error.alias("error"))
    return rows.select("o_orderkey", F.when(F.col("f").isNotNull(), F.size("f")).cast("long").alias("n"), "error", F.col("f")[3].alias("last"))


@query(r"""SELECT doc_id, CAST(len(list_filter(l, lambda x: regexp_matches(x, '[^\x09-\x0D \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]'))) AS BIGINT) AS rows, CAST(len(l) AS BIGINT) AS lines
    FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)""")
def blank_line_count(spark, sf):
    lines = table(spark, sf, "documents").select("doc_id", F.split("text", "\n").alias("l"))
    return lines.select("doc_id", F.size(F.filter("l", lambda x: P.utrim(x) != "")).cast("long").alias("rows"), F.size("l").cast("long").alias("lines"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) / CAST(100 AS DECIMAL(3,0)) AS DECIMAL(18,2)) END AS value,
    CASE WHEN o_orderkey % 10 = 0 THEN 'Invalid numeric value: 1.2,3,4' END AS error FROM orders""")
def typed_numeric(spark, sf):
    """Thousands in dots, decimals after a comma; blanks, and what is no number."""
    raw = F.expr("""case when o_orderkey % 10 = 0 then '1.2,3,4' when o_orderkey % 5 = 0 then ' ' else concat(
        if(o_totalprice >= 1000, concat(cast(round(o_totalprice * 100) as bigint) div 100000, '.'), ''), if(o_totalprice >= 1000, lpad(cast(cast(round(o_totalprice * 100) as bigint) div 100 % 1000 as string), 3, '0'), cast(cast(round(o_totalprice * 100) as bigint) div 100 as string)),
        ',', lpad(cast(cast(round(o_totalprice * 100) as bigint) % 100 as string), 2, '0')) end""")
    value, error = P.numeric(F.col("raw"))
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw")).select("o_orderkey", value.alias("value"), error.alias("error"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 OR o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS value,
    CASE WHEN o_orderkey % 7 = 0 THEN 'Invalid date value: 20240230' END AS error FROM orders""")
def typed_date(spark, sf):
    raw = F.expr("case when o_orderkey % 7 = 0 then '20240230' when o_orderkey % 5 = 0 then '00000000' when o_orderkey % 3 = 0 then '2024-01-31' else date_format(o_orderdate, 'yyyyMMdd') end")
    value, error = P.date(F.col("raw"))
    return table(spark, sf, "orders").select("o_orderkey", raw.alias("raw")).select("o_orderkey", value.alias("value"), error.alias("error"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS value FROM events""")
def typed_bool(spark, sf):
    value, _ = P.boolean(F.expr("case event_id % 4 when 0 then ' S' when 1 then 'n' when 2 then 'YES' else event_type end"))
    return table(spark, sf, "events").select("event_id", value.alias("value"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN -user_id WHEN event_id % 3 = 1 THEN user_id END AS value FROM events""")
def typed_int(spark, sf):
    value, _ = P.integer(F.expr("case event_id % 3 when 0 then concat(' -', user_id) when 1 then concat(user_id, ' ') else concat(user_id, '.5') end"))
    return table(spark, sf, "events").select("event_id", value.alias("value"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '00' ELSE c_mktsegment END AS company_size_code FROM customer""")
def default_codes(spark, sf):
    lines = table(spark, sf, "customer").select("c_custkey", F.expr("concat('x;', if(c_custkey % 4 = 0, ' ', c_mktsegment))").alias("value"))
    return N.normalized(lines, (Field("name"), Field("company_size_code", "text", True)), {"company_size_code": "00"}).select("c_custkey", "company_size_code")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 6 IN (0, 2, 4) THEN 'Missing required value for a.' WHEN c_custkey % 6 = 3 THEN 'Missing required value for b.' END AS error FROM customer""")
def required_check(spark, sf):
    lines = table(spark, sf, "customer").select("c_custkey", F.expr("concat(if(c_custkey % 2 = 0, '', c_name), ';', if(c_custkey % 3 = 0, ' ', c_mktsegment))").alias("value"))
    return N.normalized(lines, (Field("a", "text", True), Field("b", "text", True))).select("c_custkey", "error")


@query(f"SELECT o_orderkey, cnpj_root, company_name, legal_nature_code, responsible_qualification_code, share_capital, company_size_code, CAST(NULL AS VARCHAR) AS responsible_federative_entity FROM ({COMPANY}) WHERE error IS NULL")
def normalize_split_valid(spark, sf):
    return N.valid(company_rows(spark, sf)).drop("value")


@query(f"SELECT row_number, dataset, file_path, error_category, error_message, can_retry_later FROM ({QUARANTINE})")
def normalize_split_quarantine(spark, sf):
    return company_quarantine(spark, sf).select("row_number", "dataset", "file_path", "error_category", "error_message", "can_retry_later")


@query("""SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'invalid_utf8_sequence' WHEN 1 THEN 'not_null_violation' WHEN 2 THEN 'foreign_key_violation' WHEN 3 THEN 'invalid_field_count' WHEN 4 THEN 'transform_error' ELSE 'unknown' END AS category,
    event_id % 7 IN (0, 3, 4) AS retryable FROM events""")
def error_classify(spark, sf):
    message = F.expr("""case event_id % 7 when 0 then 'Invalid byte sequence for encoding UTF8' when 1 then 'null value violates not-null constraint' when 2 then 'row violates foreign key constraint'
        when 3 then 'Unexpected field count: 3' when 4 then 'could not Transform' else event_type end""")
    return table(spark, sf, "events").select("event_id", P.classify(message).alias("k")).select("event_id", "k.category", "k.retryable")


@query(f"SELECT count(*) AS total, count(*) FILTER (WHERE can_retry_later) AS retryable, count(*) FILTER (WHERE NOT can_retry_later) AS terminal FROM ({QUARANTINE})")
def quarantine_totals(spark, sf):
    return Q.totals(company_quarantine(spark, sf))


@query(f"SELECT dataset AS key, count(*) AS count FROM ({QUARANTINE}) WHERE NOT can_retry_later GROUP BY 1")
def quarantine_by_dataset(spark, sf):
    return Q.counts(company_quarantine(spark, sf), "dataset", terminal=True)


@query(f"SELECT error_category AS key, count(*) AS count FROM ({QUARANTINE}) GROUP BY 1")
def quarantine_by_category(spark, sf):
    return Q.counts(company_quarantine(spark, sf), "error_category")


@query(f"SELECT 'unknown' AS key, count(*) AS count FROM ({QUARANTINE}) WHERE dataset = 'companies'")
def quarantine_by_stage(spark, sf):
    return Q.counts(company_quarantine(spark, sf), "error_stage", dataset="companies")


@query(f"SELECT id, dataset, error_message FROM ({QUARANTINE}) WHERE id > 100 AND dataset = 'companies' AND error_category = 'unknown' ORDER BY id LIMIT 20")
def quarantine_page(spark, sf):
    return Q.page(company_quarantine(spark, sf), 20, 100, dataset="companies", category="unknown").select("id", "dataset", "error_message")


@query(f"SELECT id, dataset, file_path, error_message FROM ({QUARANTINE}) WHERE id = 33")
def quarantine_show(spark, sf):
    return Q.record(company_quarantine(spark, sf), 33).select("id", "dataset", "file_path", "error_message")


@query("""SELECT doc_id, text, CAST(len(string_split(text, 'e')) - 1 AS BIGINT) AS removed FROM documents""")
def nul_sanitize(spark, sf):
    """A NUL behind each e goes again."""
    clean, n = P.without_nul(F.replace("text", F.lit("e"), F.lit("e\x00")))
    return table(spark, sf, "documents").select("doc_id", clean.alias("text"), n.alias("removed"))


@query("""SELECT source, CAST(sum(len(text) - len(replace(text, chr(10), '')) + CASE WHEN text <> '' AND NOT suffix(text, chr(10)) THEN 1 ELSE 0 END) AS BIGINT) AS lines, CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM documents GROUP BY source""")
def line_stats(spark, sf):
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + F.when((F.col("text") != "") & ~F.col("text").endswith("\n"), 1).otherwise(0)
    return table(spark, sf, "documents").groupBy("source").agg(F.sum(lines).cast("long").alias("lines"), F.sum(F.octet_length("text")).cast("long").alias("bytes"))


def _lookup(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderpriority").alias("code"), F.lower("o_orderpriority").alias("description")).filter("code < '3'").distinct()


LOOKUP = "SELECT DISTINCT o_orderpriority AS code, lower(o_orderpriority) AS description FROM orders WHERE o_orderpriority < '3'"


@query("SELECT DISTINCT trim(o_orderpriority) AS code FROM orders WHERE trim(o_orderpriority) <> ''")
def lookup_distinct(spark, sf):
    empty = spark.createDataFrame([], "code string")
    return TB.missing_codes(table(spark, sf, "orders"), "o_orderpriority", empty)


@query(f"SELECT DISTINCT o_orderpriority AS code FROM orders WHERE o_orderpriority NOT IN (SELECT code FROM ({LOOKUP}))")
def lookup_missing(spark, sf):
    return TB.missing_codes(table(spark, sf, "orders"), "o_orderpriority", _lookup(spark, sf))


@query(f"SELECT code, description FROM ({LOOKUP}) UNION ALL SELECT DISTINCT o_orderpriority, 'Imported placeholder CNAE (' || o_orderpriority || ')' FROM orders WHERE o_orderpriority >= '3'")
def lookup_placeholders(spark, sf):
    rows = table(spark, sf, "orders").select(F.concat(F.lit(" "), "o_orderpriority").alias("main_cnae_code"))
    known = _lookup(spark, sf)
    return known.unionByName(M.placeholders(rows, "establishments", {"cnaes": known})["cnaes"])


@query("""SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') || lpad(CAST(l_linenumber AS VARCHAR), 4, '0') || CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE lpad(CAST(l_suppkey % 100 AS VARCHAR), 2, '0') END AS cnpj_full, count(*) AS n FROM lineitem GROUP BY 1""")
def cnpj_full_key(spark, sf):
    parts = F.expr("lpad(cast(l_orderkey as string), 8, '0')"), F.expr("lpad(cast(l_linenumber as string), 4, '0')"), F.expr("if(l_partkey % 9 = 0, null, lpad(cast(l_suppkey % 100 as string), 2, '0'))")
    return table(spark, sf, "lineitem").groupBy(P.cnpj_full(*parts).alias("cnpj_full")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, md5(CAST(o_custkey AS VARCHAR) || '|' || o_orderstatus || '|' || c_name || '|' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE c_mktsegment END || '|' || o_orderpriority || '|' ||
    CAST(CAST(o_orderdate AS DATE) - DATE '2000-01-01' AS VARCHAR) || '|' || '' || '|' || CAST(c_nationkey AS VARCHAR) || '|' || '' || '|' || o_orderstatus || '|' || '0') AS key
    FROM orders JOIN customer ON o_custkey = c_custkey""")
def partner_key(spark, sf):
    none = F.lit(None).cast("string")
    columns = [F.col("o_custkey"), F.col("o_orderstatus"), F.col("c_name"), F.expr("if(o_orderkey % 3 = 0, null, c_mktsegment)"), F.col("o_orderpriority"), F.col("o_orderdate").cast("date"), none, F.col("c_nationkey"), none, F.col("o_orderstatus"), F.lit(0)]
    rows = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select("o_orderkey", P.dedupe_key(columns, 5).alias("key"))


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def partner_dedupe_first(spark, sf):
    return TB.first_wins(table(spark, sf, "events").select("user_id", "event_type", "event_id"), ("user_id", "event_type"), "event_id")


@query("""SELECT o_custkey, CASE WHEN n IS NULL THEN old ELSE n END AS o_orderkey, CASE WHEN old IS NULL THEN 'new' ELSE 'old' END AS created, CASE WHEN n IS NULL THEN 'old' ELSE 'new' END AS updated FROM (
    SELECT o_custkey, max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 0) AS old, max(o_orderkey) FILTER (WHERE o_orderkey % 2 = 1) AS n FROM orders GROUP BY o_custkey)""")
def upsert_last_wins(spark, sf):
    rows = table(spark, sf, "orders").select("o_custkey", "o_orderkey")
    old = TB.last_wins(rows.filter("o_orderkey % 2 = 0"), ("o_custkey",), "o_orderkey").withColumns({"created_at": F.lit("old"), "updated_at": F.lit("old")})
    new = TB.last_wins(rows.filter("o_orderkey % 2 = 1"), ("o_custkey",), "o_orderkey")
    return TB.upsert(old, new, ("o_custkey",), F.lit("new")).withColumnsRenamed({"created_at": "created", "updated_at": "updated"})


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN upper(n_name) || '!' ELSE n_name END AS n_name FROM nation WHERE n_nationkey % 2 = 0 OR n_nationkey < 12")
def upsert_domain(spark, sf):
    rows = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return TB.upsert(rows.filter("n_nationkey < 12"), rows.filter("n_nationkey % 2 = 0").withColumn("n_name", F.concat(F.upper("n_name"), F.lit("!"))), ("n_nationkey",))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100")
def chunk_page(spark, sf):
    return M.chunk(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), 500, 100, "o_orderkey")


@query("SELECT count(*) AS rows, coalesce(max(o_orderkey), 0) AS last_id FROM (SELECT o_orderkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 1000)")
def chunk_summary(spark, sf):
    return M.state(M.chunk(table(spark, sf, "orders"), 500, 1000, "o_orderkey"), "o_orderkey")


@query("SELECT count(*) AS rows, coalesce(max(l_orderkey), 0) AS last_id FROM lineitem")
def staging_state(spark, sf):
    return M.state(table(spark, sf, "lineitem"), "l_orderkey")


@query("""SELECT dataset, count(*) AS rows FROM (SELECT DISTINCT event_type AS dataset, 'f' || CAST(user_id % 5 AS VARCHAR) AS f, event_id % 1000 AS r FROM events WHERE user_id % 5 < 2 AND event_id % 3 <> 0) GROUP BY dataset""")
def quarantined_distinct(spark, sf):
    rows = table(spark, sf, "events").selectExpr("event_type AS dataset", "concat('f', user_id % 5) AS file_path", "if(event_id % 3 = 0, null, event_id % 1000) AS row_number")
    files = rows.select("dataset").distinct().crossJoin(spark.range(5)).selectExpr("dataset", "concat('f', id) AS file_path", "if(id < 2, 7, 8) AS plan_id")
    return Q.quarantined_rows(rows, files, 7)


def _files(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("dataset"), F.concat(F.lit("f"), (F.col("o_custkey") % 10).cast("string")).alias("file_path")).agg(F.count(F.lit(1)).alias("rows"), F.count(F.lit(1)).alias("file_size")).withColumn("file_mtime", F.lit(0).cast("long"))


FILES = "SELECT o_orderstatus AS dataset, 'f' || CAST(o_custkey % 10 AS VARCHAR) AS file_path, o_custkey % 10 AS k, count(*) AS rows FROM orders GROUP BY 1, 2, 3"


@query(f"SELECT dataset, count(*) AS files, CAST(sum(rows) AS BIGINT) AS rows, CAST(sum((rows + 49) // 50) AS BIGINT) AS batches FROM ({FILES}) GROUP BY dataset")
def plan_totals(spark, sf):
    return PL.plan_totals(_files(spark, sf), 50)


def _checkpoints(spark, sf):
    """Of even files complete, of every third half done, of file 5 from another version."""
    k = F.substring("file_path", 2, 9).cast("int")
    rows = _files(spark, sf).filter((k % 2 == 0) | (k % 3 == 0) | (k == 5))
    part = F.when(k % 2 == 0, F.col("rows")).otherwise(F.floor(F.col("rows") / 2)).cast("long")
    return rows.select("dataset", "file_path", "file_size", F.when(k == 5, 1).otherwise(0).cast("long").alias("file_mtime"), part.alias("byte_offset"), part.alias("rows_committed"), F.when(k % 2 == 0, "completed").otherwise("in_progress").alias("status"))


COMMITTED = f"SELECT dataset, k, rows, CASE WHEN k % 2 = 0 THEN rows WHEN k % 3 = 0 THEN rows // 2 ELSE 0 END AS c FROM ({FILES})"


@query(f"SELECT dataset, CAST(sum(c) AS BIGINT) AS rows_done, CAST(sum((c + 49) // 50) AS BIGINT) AS batches_done, count(*) FILTER (WHERE k % 2 = 0) AS skipped, count(*) FILTER (WHERE k % 2 = 1 AND c > 0) AS resumed FROM ({COMMITTED}) GROUP BY dataset")
def hydrate_totals(spark, sf):
    return PL.hydrated_totals(PL.hydrated(_files(spark, sf), _checkpoints(spark, sf), 50))


@query(f"SELECT dataset, file_path FROM ({FILES}) WHERE k % 2 = 1")
def skip_completed(spark, sf):
    return PL.hydrated(_files(spark, sf), _checkpoints(spark, sf), 50).filter("NOT done").select("dataset", "file_path")


@query(f"SELECT dataset, CAST(greatest(0, sum(c) - CASE dataset WHEN 'F' THEN 3 WHEN 'O' THEN 1000000000 ELSE 0 END) AS BIGINT) AS rows FROM ({COMMITTED}) GROUP BY dataset")
def expected_staged(spark, sf):
    bad = spark.createDataFrame([("F", 3), ("O", 1000000000)], "dataset string, rows long")
    return PL.expected_staged(PL.hydrated(_files(spark, sf), _checkpoints(spark, sf), 50), bad)


@query("SELECT user_id, event_id AS id FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, value DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def latest_plan(spark, sf):
    plans = table(spark, sf, "events").selectExpr("user_id", "event_id AS id", "ts AS last_used_at", "value AS updated_at")
    return PL.latest(plans, ["user_id"]).select("user_id", "id")


@query("SELECT event_type, round(CASE WHEN sum(ms) > 0 THEN sum(n) / (sum(ms) / 1000.0) ELSE 0 END, 4) AS rows_per_second, round(CASE WHEN sum(ms) > 0 THEN count(*) / (sum(ms) / 60000.0) ELSE 0 END, 4) AS batches_per_minute FROM (SELECT event_type, event_id % 100 AS n, user_id + 1 AS ms FROM events) GROUP BY 1")
def perf_rollup(spark, sf):
    rows = table(spark, sf, "events").selectExpr("event_type", "event_id % 100 AS n", "user_id + 1 AS ms").groupBy("event_type").agg(F.sum("n").alias("n"), F.sum("ms").alias("ms"), F.count(F.lit(1)).alias("b"))
    return rows.select("event_type", F.round(PL.rate(F.col("n"), F.col("ms")), 4).alias("rows_per_second"), F.round(PL.rate(F.col("b"), F.col("ms"), 60000), 4).alias("batches_per_minute"))


@query("SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F'")
def delete_checkpoints(spark, sf):
    rows = table(spark, sf, "orders").selectExpr("o_orderkey", "o_orderstatus AS dataset")
    gone = rows.filter("dataset = 'F'").select("dataset").distinct()
    return PL.without(rows, gone, ["dataset"]).select("o_orderkey")


@query("SELECT (SELECT count(*) FROM orders WHERE o_orderkey % 5 <> 0) AS plans, (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0)) AS files, (SELECT count(*) FROM events WHERE event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 5 = 0)) AS checkpoints")
def delete_cascade(spark, sf):
    plans, files, points = PL.delete_plans(table(spark, sf, "orders").withColumnRenamed("o_orderkey", "id"), table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "plan_id"), table(spark, sf, "events").withColumnRenamed("event_id", "plan_id"), F.col("id") % 5 == 0)
    counted = [x.agg(F.count(F.lit(1)).alias(n)) for x, n in ((plans, "plans"), (files, "files"), (points, "checkpoints"))]
    return counted[0].join(counted[1], how="cross").join(counted[2], how="cross")  # one row each


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey = 7 THEN 'done' ELSE o_orderstatus END AS status, o_orderpriority AS phase FROM orders")
def phase_update(spark, sf):
    return PL.phase_update(table(spark, sf, "orders").selectExpr("o_orderkey AS id", "o_orderstatus AS status", "o_orderpriority AS phase"), 7, status="done", phase=None)


@query("SELECT dataset FROM (VALUES ('companies'), ('establishments'), ('partners'), ('simples_options'), ('countries'), ('cities'), ('partner_qualifications'), ('legal_natures'), ('cnaes'), ('reasons')) t(dataset) WHERE dataset NOT IN ('companies', 'cities')")
def missing_datasets(spark, sf):
    expected = spark.createDataFrame([(d,) for d in LAYOUTS], "dataset string")
    present = table(spark, sf, "nation").select(F.when(F.col("n_nationkey") % 2 == 0, "companies").otherwise("cities").alias("dataset"))
    return PL.without(expected, present, ["dataset"])


@query("SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_returnflag NOT IN ('S', 'N') GROUP BY 1")
def check_flags(spark, sf):
    rows = table(spark, sf, "lineitem").selectExpr("l_returnflag", "l_returnflag AS simples_option_flag", "cast(null as string) AS mei_option_flag")
    return M.flag_violations(rows).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))


NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n FROM {n}" for n in NAMES))
def table_counts(spark, sf):
    parts = [table(spark, sf, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n")) for n in NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'companies' WHEN 1 THEN 'establishments' WHEN 2 THEN 'cities' WHEN 3 THEN 'zip-archive' WHEN 4 THEN 'unknown' WHEN 5 THEN 'companies' WHEN 6 THEN 'cnaes' ELSE 'partners' END AS dataset FROM documents""")
def dataset_infer(spark, sf):
    """The dataset of names of both spellings; a table of the different names is made on the driver."""
    names = ("x/Empresas0.CSV", "K3241.ESTABELE", "Munic\u00edpios1.csv", "socios/Socios2.zip", "readme.txt", "a/EMPRECSV", "F.K03200.CNAECSV", "S\u00f3cios")
    known = spark.createDataFrame([(i, S.dataset_of(n)) for i, n in enumerate(names)], "i bigint, dataset string")
    return table(spark, sf, "documents").withColumn("i", F.col("doc_id") % 8).join(F.broadcast(known), "i").select("doc_id", "dataset")


def _file_lines(spark, sf):
    """Each document as a file of one split; every third line ends in CR LF."""
    lines = table(spark, sf, "documents").select("doc_id", "text", F.posexplode(F.split("text", "\n")).alias("i", "line"))
    lines = lines.filter(~((F.col("line") == "") & (F.col("i") == F.size(F.split("text", "\n")) - 1)))
    cr = F.col("i") % 3 == 0
    return lines.select(
        F.col("doc_id").cast("string").alias("file_path"), F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("size"), F.col("i").cast("long").alias("at"),
        (F.octet_length("line") + cr.cast("int")).alias("bytes"), cr.alias("cr"), F.col("line").alias("value"), F.endswith("text", F.lit("\n")).alias("ended"),
    )


def _numbered(spark, sf, after=0):
    lines = _file_lines(spark, sf)
    sizes = lines.groupBy("file_path").agg((F.sum(F.col("bytes") + 1) - F.max(F.when(F.col("ended"), 0).otherwise(1))).alias("file_size"))
    return S.numbered(lines.join(sizes, "file_path").drop("size", "ended"), after)


LINES = """
    SELECT doc_id, text, CAST(i AS BIGINT) AS i, line, (i - 1) % 3 = 0 AS cr FROM (
        SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
    WHERE NOT (line = '' AND i = len(string_split(text, chr(10))))"""
PLACED = f"""
    SELECT doc_id, i, line, cr, text, sum(strlen(line) + cr::INT + 1) OVER (PARTITION BY doc_id ORDER BY i) AS b, sum(strlen(line) + cr::INT + 1) OVER (PARTITION BY doc_id) AS whole FROM ({LINES})"""
#: the last line of a document that does not end in LF has none
NUMBERED = """
    SELECT CAST(doc_id AS VARCHAR) AS file_path, row_number() OVER o AS line_number, CAST(sum((trim(line, ' ' || chr(9) || chr(13) || chr(11) || chr(12) || chr(160)) <> '')::INT) OVER o AS BIGINT) AS row_number,
        CAST(CASE WHEN b = whole AND NOT suffix(text, chr(10)) THEN b - 1 ELSE b END AS BIGINT) AS next_offset, line || CASE WHEN cr AND b = whole AND NOT suffix(text, chr(10)) THEN chr(13) ELSE '' END AS value
    FROM ({placed}) WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)"""


@query(NUMBERED.format(placed=PLACED))
def line_numbers(spark, sf):
    """Lines with numbers and offsets; a last line without LF keeps its CR."""
    return _numbered(spark, sf)


@query(NUMBERED.format(placed=f"SELECT * FROM ({PLACED}) WHERE b - strlen(line) - cr::INT - 1 >= 300"))
def resumed_lines(spark, sf):
    """Lines that start at offset 300 or later, numbered from there."""
    return _numbered(spark, sf, 300)


@query("SELECT page_id, CASE WHEN len(string_split(url, '/')) > 1 THEN string_split(url, '/')[-2] || ' > ' || string_split(url, '/')[-1] ELSE url END AS shown FROM pages")
def display_path(spark, sf):
    return table(spark, sf, "pages").select("page_id", P.display_path(F.col("url")).alias("shown"))


@query(r"""SELECT conv_id || chr(9) || turn || chr(9) || CASE WHEN turn % 3 = 0 THEN '\N' ELSE replace(replace(replace(replace('\' || text || chr(13) || chr(11), '\', '\\'), chr(10), '\n'), chr(13), '\r'), chr(11), '\v') END || chr(9) || CASE WHEN role = 'user' THEN 't' ELSE 'f' END AS value FROM conversations""")
def copy_text(spark, sf):
    """Rows as COPY text: escaped, missing values as \\N, booleans as t and f."""
    text = F.when(F.col("turn") % 3 != 0, F.concat(F.lit("\\"), "text", F.lit("\r\x0b")))
    return copy_lines(table(spark, sf, "conversations").select("conv_id", "turn", text.alias("text"), (F.col("role") == "user").alias("own")))


@query("""SELECT o_orderkey, lpad(CAST(o_orderkey AS VARCHAR), 8, '0') AS code, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS description FROM orders""")
def payload_round_trip(spark, sf):
    """A quarantined row's fields to JSON and back."""
    fields = F.struct(F.lpad(F.col("o_orderkey").cast("string"), 8, "0").alias("code"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("description"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.to_json(fields, {"ignoreNullFields": "false"}).alias("p"))
    return rows.select("o_orderkey", F.from_json("p", schema("cities")).alias("p")).select("o_orderkey", "p.*")


@query("""SELECT user_id AS file_size, event_type AS dataset, max(event_id) AS rows_committed, CAST(CASE WHEN max(event_id) % 2 = 0 THEN 'completed' ELSE 'in_progress' END AS VARCHAR) AS status FROM events GROUP BY 1, 2""")
def checkpoint_upsert(spark, sf):
    """Checkpoints of two commits, one after the other: the later one of a file stands, other files' stay."""
    rows = table(spark, sf, "events").select(F.col("event_type").alias("dataset"), F.col("user_id").alias("file_size"), F.col("event_id").alias("rows_committed"), F.when(F.col("event_id") % 2 == 0, "completed").otherwise("in_progress").alias("status"))
    keys, half = ("dataset", "file_size"), rows.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY rows_committed)")).first()[0]
    first, second = (TB.last_wins(rows.filter(c), keys, "rows_committed") for c in (F.col("rows_committed") <= half, F.col("rows_committed") > half))
    return TB.upsert(first, second, keys).select("file_size", "dataset", "rows_committed", "status")


@query("""SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS cnpj_root, arg_max(CASE WHEN l_linenumber % 2 = 0 THEN 'S' ELSE 'N' END, id) AS simples_option_flag, max(id) AS staging_id
    FROM (SELECT *, l_orderkey * 100000000 + l_partkey * 100 + l_linenumber AS id FROM lineitem) GROUP BY 1""")
def merge_chunks(spark, sf):
    """Staged rows taken in by chunks of ids; what several chunks have of a key becomes one row, the last."""
    rows = table(spark, sf, "lineitem").select(
        F.lpad(F.col("l_orderkey").cast("string"), 8, "0").alias("cnpj_root"), F.when(F.col("l_linenumber") % 2 == 0, "S").otherwise("N").alias("simples_option_flag"),
        (F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 100 + F.col("l_linenumber")).alias("staging_id"), F.lit(None).cast("string").alias("mei_option_flag"),
    )
    cut = F.col("staging_id") % 3  # chunks by id; any split gives the same
    chunks = [M.deduped(M.keyed(rows.filter(cut == k), "simples_options"), "simples_options") for k in range(3)]
    return M.checked(M.deduped(chunks[0].unionByName(chunks[1]).unionByName(chunks[2]), "simples_options"), "simples_options").select("cnpj_root", "simples_option_flag", "staging_id")


@query("""SELECT column_name, target FROM (VALUES ('legal_nature_code', 'legal_natures'), ('responsible_qualification_code', 'partner_qualifications'), ('company_size_code', 'company_sizes')) t(column_name, target)""")
def referring_columns(spark, sf):
    """Coded columns of a stored table and the lookups they refer to: a join of the catalog with what refers to what."""
    stored = company_rows(spark, sf).schema
    columns = spark.createDataFrame([("companies", f.name) for f in stored], "table_name string, column_name string")
    refers = spark.createDataFrame([(d, c, t) for d, of in REFERENCES.items() for c, t in of.items()], "table_name string, column_name string, target string")
    return refers.join(columns, ["table_name", "column_name"]).select("column_name", "target")

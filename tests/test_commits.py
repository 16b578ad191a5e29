"""Commits: what readers see while tables change, loads and materialisations that are cut off, and how they go on."""

import io
import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerspark import api, ddl, logs, reporters
from ledgerspark.errors import ServiceError, ValidationError
from ledgerspark.operators import tables as TB
from ledgerspark.operators.export import export_copy
from ledgerspark.plans import planning as PL
from ledgerspark.sources import files as S
from ledgerspark.warehouse import Warehouse

SIMPLES = "".join(f"{i:08d};{'SN'[i % 2]};20200101;00000000;N;;\n" + ("\n" if i % 4 == 0 else "") for i in range(12)) + "bad;S;20200230;;N;;\n"
COUNTRIES = "105;BRASIL\r\n13;AFEGANISTAO\r\n"


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "dump"
    root.mkdir()
    (root / "Simples0.csv").write_text(SIMPLES)
    (root / "Simples1.csv").write_text("00000003;S;20210101;;S;;\n00000050;S;20210101;;S;;\n")
    (root / "Paises.csv").write_text(COUNTRIES)
    return str(root)


def options(**more):
    return api.Options(**{"dataset": "simples_options"} | more)


class Cut(Exception):
    pass


def cut_at(monkeypatch, n):
    """Lets the n-th write of a file or of rows fail from now on, as if the driver died there."""
    left, put, write = [n], TB.Store.put, TB.Table._write

    def counted(f):
        def run(*args):
            left[0] -= 1
            if left[0] < 0:
                raise Cut
            return f(*args)

        return run

    monkeypatch.setattr(TB.Store, "put", counted(put))
    monkeypatch.setattr(TB.Table, "_write", counted(write))


def whole(w):
    rows = {(r.cnpj_root, r.simples_option_flag) for r in w.read("simples_options").collect()}
    staged = sorted((r.cnpj_root, r.simples_option_date) for r in w.read("staging_simples_options").collect())
    bad = [(r.dataset, r.row_number, r.checkpoint_offset) for r in w.read("import_quarantine").collect()]
    ids = [r.staging_id for r in w.read("staging_simples_options").collect()]
    return rows, staged, bad, len(set(ids)) == len(ids)


def test_cut_anywhere(spark, tree, tmp_path, monkeypatch):
    """An import that stops before any of its writes goes on with nothing lost or doubled."""
    want = Warehouse(spark, str(tmp_path / "want"))
    api.run_import(want, tree, options())
    for n in (2, 6, 9, 13):
        w = Warehouse(spark, str(tmp_path / f"w{n}"))
        with monkeypatch.context() as m:
            cut_at(m, n)
            with pytest.raises(Cut):
                api.run_import(w, tree, options())
        w = Warehouse(spark, str(tmp_path / f"w{n}"))  # a new driver
        api.run_import(w, tree, options())
        assert whole(w) == whole(want), n


def test_commits_and_cursor(spark, tree, tmp_path):
    """The batch size is the number of rows between commits; a load goes on at the row behind the last commit."""
    w = Warehouse(spark, str(tmp_path / "w"))
    small = options(load_batch_size=4, batches_a_commit=1)
    seen = []

    def stop(event):
        if event["event"] == "batch_committed":
            seen.append(event)
            if len(seen) == 2:
                raise Cut

    small.on_progress = stop
    with pytest.raises(Cut):
        api.load(w, tree, small)
    half = {os.path.basename(x["file_path"]): x for x in w.control("import_checkpoints").rows()}["Simples0.csv"]
    assert half["rows_committed"] == 8 and half["byte_offset"] == len("".join(SIMPLES.splitlines(True)[:10])) and w.read("staging_simples_options").count() == 8
    small.on_progress = None
    status = api.plan_status(w, 1).first()
    assert (status.files, status.rows, status.batches, status.rows_done, status.batches_done, status.resumed, status.expected) == (2, 15, 5, 8, 2, 1, 8)
    done = api.load(w, tree, small)["datasets"][0]
    assert (done["resumed"], done["commits"], done["rows"], done["quarantined"]) == (1, 2, 6, 1)
    assert {x["status"] for x in w.control("import_checkpoints").rows()} == {"completed"}
    one = Warehouse(spark, str(tmp_path / "one"))
    assert api.load(one, tree, options())["datasets"][0]["commits"] == 1
    assert whole(one)[1:] == whole(w)[1:]
    # chunks of a materialisation
    events = []
    out = api.materialize(w, tree, options(materialize_batch_size=5, chunks_a_commit=1, on_progress=events.append))["datasets"][0]
    assert out["chunks"] == 3 and api.materialize(one, tree, options())["datasets"][0]["chunks"] == 1
    assert whole(one) == whole(w) and w.read("merging_simples_options").isEmpty()
    assert {"materialization_staging_validation_completed", "materialization_chunk_completed"} <= {e["event"] for e in events}
    # nothing new: known counts are used again
    events.clear()
    assert api.materialize(w, tree, options(on_progress=events.append))["datasets"][0]["step"] == "keep"
    assert [e["reused"] for e in events if e["event"] == "materialization_staging_validation_checked"] == [True]


def test_staging_must_agree(spark, tree, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    api.load(w, tree, options())
    w.table("staging_simples_options").delete(F.col("cnpj_root") == "00000001")
    with pytest.raises(ValidationError, match="13 rows, 14 are expected"):
        api.materialize(w, tree, options())
    api.clean_staging(w, "simples_options")
    with pytest.raises(ValidationError, match="empty"):
        api.materialize(w, tree, options())
    assert w.control("import_materialization_checkpoints").rows() == []


def test_failed_dataset(spark, tree, tmp_path):
    """Rows that don't add up: the load fails, says so in the checkpoints, and leaves no rows."""
    w = Warehouse(spark, str(tmp_path / "w"))
    plan = api.plan_import(w, tree, options())
    for f in plan.files:
        f["rows"] += 1
    with pytest.raises(ServiceError):
        api.load_dataset(w, plan, "simples_options", options())
    assert {x["status"] for x in w.control("import_checkpoints").rows()} == {"failed"} and w.read("staging_simples_options").isEmpty()


def test_readers_see_whole_states(spark, tmp_path):
    store = TB.Store(spark, str(tmp_path / "s"))
    schema = spark.range(0).schema
    a, b = TB.Table(store, "a", schema), TB.Table(store, "b", schema)
    a.replace(spark.range(5))
    other = TB.Store(spark, str(tmp_path / "s"))
    seen = lambda: (TB.Table(other, "a", schema).read().count(), TB.Table(other, "b", schema).read().count())
    with store.transaction():
        a.append(spark.range(3))
        b.replace(spark.range(2))
        assert seen() == (5, 0) and a.read().count() == 8
    assert seen() == (8, 2)
    with pytest.raises(Cut), store.transaction():
        a.truncate()
        b.append(spark.range(9))
        raise Cut
    assert seen() == (8, 2) and len(os.listdir(tmp_path / "s" / "b")) == 1
    with pytest.raises(TB.Conflict), store.transaction():
        a.truncate()
        TB.Table(other, "b", schema).replace(spark.range(7))
    assert seen() == (8, 7)
    for i in range(5):
        a.replace(spark.range(i))
    assert len(os.listdir(tmp_path / "s" / "a")) <= 2 * TB.KEPT and seen() == (4, 7) and a.delete(F.col("id") > 1) == 2


def test_plan_and_files_are_one(spark, tree, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "w"))
    with monkeypatch.context() as m:
        cut_at(m, 1)
        with pytest.raises(Cut):
            api.plan_import(w, tree, options())
    assert w.read("import_plan_files").isEmpty() and w.read("import_plans").isEmpty()
    plan = api.plan_import(w, tree, options())
    assert [f["display_path"] for f in plan.files] == ["dump > Simples0.csv", "dump > Simples1.csv"] and plan.id == 1
    mixed = [{"dataset_index": d, "file_index": f} for d, f in ((1, 0), (0, 1), (0, 0))]
    assert [(x["dataset_index"], x["file_index"]) for x in PL.in_order(mixed)] == [(0, 0), (0, 1), (1, 0)]


def test_stream(spark, tree, tmp_path):
    w, folder, checkpoint = Warehouse(spark, str(tmp_path / "w")), tmp_path / "in", str(tmp_path / "checkpoint")
    folder.mkdir()
    (folder / "a.csv").write_text(SIMPLES)
    assert api.stream(w, str(folder), "simples_options", checkpoint) == 1 and w.read("staging_simples_options").count() == 12
    assert api.stream(w, str(folder), "simples_options", checkpoint) == 0
    (folder / "b.csv").write_text("00000077;S;20210101;;S;;\n")
    assert api.stream(w, str(folder), "simples_options", checkpoint) == 1
    ids = sorted(r.staging_id for r in w.read("staging_simples_options").collect())
    assert ids == list(range(1, 14)) and [r.id for r in w.read("import_quarantine").collect()] == [1]


def test_capabilities_and_shapes(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "w"))
    assert set(w.capabilities().values()) == {False}
    api.seeds(w)
    w.table("establishments").replace(w.read("establishments"))
    found = w.capabilities()
    assert found["establishments.cnpj_full"] and found["requires_lookup_reconciliation"] and not found["partners.partner_dedupe_key"]
    w.ensure_shape("establishments")
    old = TB.Table(w.store, "establishments", spark.range(0).schema)
    old.replace(spark.range(1))
    with pytest.raises(ValidationError, match="cnpj_full"):
        w.ensure_shape("establishments", "No.")


def test_mixed_tree(tmp_path):
    import zipfile

    (tmp_path / "extracted").mkdir()
    (tmp_path / "extracted" / "Paises.csv").write_text(COUNTRIES)
    (tmp_path / "other.txt").write_text("x")
    with zipfile.ZipFile(tmp_path / "Paises.zip", "w") as z:
        z.writestr("PAISCSV", COUNTRIES)
    path, entries = S.selected(str(tmp_path))
    assert path == str(tmp_path / "extracted") and [e.path for e in entries] == [".", "Paises.csv"]
    found = S.validate(str(tmp_path))
    assert found["present"] == ["countries"] and not found["warnings"]
    (tmp_path / "extracted").rename(tmp_path / "in")
    path, entries = S.selected(str(tmp_path))
    assert path == str(tmp_path) and "Paises.zip" not in [e.path for e in entries] and S.inspect(str(tmp_path))
    assert S.summary(S.inspect(str(tmp_path)))["mode"] == "mixed"


def test_extract(tmp_path):
    import zipfile

    with zipfile.ZipFile(tmp_path / "A.zip", "w") as z:
        z.writestr("PAISCSV", COUNTRIES)
    with zipfile.ZipFile(tmp_path / "B.zip", "w") as z:
        z.writestr("../out.txt", "x")
    (tmp_path / "C.zip").write_bytes(b"no archive")
    done = {os.path.basename(x["archive"]): x["ok"] for x in S.extract(str(tmp_path))}
    assert done == {"A.zip": True, "B.zip": False, "C.zip": False} and (tmp_path / "extracted" / "A" / "PAISCSV").read_text(newline="") == COUNTRIES
    assert not (tmp_path / "extracted" / "out.txt").exists()


def test_modes(tmp_path):
    assert S.summary(S.inspect(str(tmp_path)))["mode"] == "empty"
    (tmp_path / "Socios.zip").write_bytes(b"")
    assert S.summary(S.inspect(str(tmp_path)))["mode"] == "zip-only"
    (tmp_path / "Socios.zip").rename(tmp_path / "Socios1.csv")
    found = S.summary(S.inspect(str(tmp_path)))
    assert found["mode"] == "extracted" and "partners" not in found["missing"] and found["next"] == "validate"
    assert [e.path for e in sorted((S.Entry(x, x, "file", 0, "") for x in ("a10", "a2", "B1")), key=lambda e: S.natural(e.path))] == ["a2", "a10", "B1"]


def test_sanitize(spark, tmp_path):
    root = tmp_path / "in"
    (root / "sub").mkdir(parents=True)
    (root / "a.csv").write_bytes(b"x\0;y\r\n\0")
    (root / "sub" / "b.csv").write_bytes(b"plain")
    got = {r.path: (r.bytes, r.removed, r.lines, r.changed) for r in S.sanitize_tree(spark, str(root), str(tmp_path / "out")).collect()}
    assert got == {"a.csv": (5, 2, 1, True), "sub/b.csv": (5, 0, 1, False)}
    assert (tmp_path / "out" / "a.csv").read_bytes() == b"x;y\r\n" and sorted(os.listdir(tmp_path / "out")) == ["a.csv", "sub"]


def test_lines_of_files(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes("a\r\n \nb\rc\né\r".encode())
    got = S.numbered(S.read_lines(spark, str(tmp_path / "x.csv"))).orderBy("line_number").collect()
    assert [(r.line_number, r.row_number, r.next_offset, r.value) for r in got] == [(1, 1, 3, "a"), (2, 1, 5, " "), (3, 2, 9, "b\rc"), (4, 3, 12, "é\r")]
    got = S.numbered(S.read_lines(spark, str(tmp_path / "x.csv")), after=5).orderBy("line_number").collect()
    assert [(r.line_number, r.row_number, r.next_offset) for r in got] == [(1, 1, 9), (2, 2, 12)]


def test_export(spark, tmp_path):
    rows = spark.createDataFrame([("a\tb\\", True, None), (None, False, 3)], "x string, y boolean, z int").coalesce(1)
    export_copy(rows, str(tmp_path / "out"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "out")).collect()) == ["\\N\tf\t3", "a\\tb\\\\\tt\t\\N"]


def test_ddl_profiles(spark):
    texts = {p: ddl.generate(p) for p in ("full", "final", "staging")}
    assert ddl.generate("operational") == texts["final"] and ddl.generate(" Stage ") == texts["staging"] and ddl.generate(None) == texts["full"]
    assert "staging_companies" not in texts["final"] and "import_plans" not in texts["staging"] and "INSERT INTO company_sizes" in texts["final"] and "select partners by cnpj_root" in texts["full"]
    with pytest.raises(ValidationError):
        ddl.generate("other")
    assert [ddl.file_name(p, n) for p, n in (("full", None), ("staging", None), ("final", "x"), ("final", "x.SQL"))] == ["schema.sql", "schema-staging.sql", "x.sql", "x.SQL"]
    spark.sql("CREATE DATABASE IF NOT EXISTS made")
    spark.sql("USE made")
    try:
        for statement in texts["full"].split(";\n"):
            body = "\n".join(x for x in statement.splitlines() if not x.startswith("--")).strip()
            if body.startswith("CREATE"):
                spark.sql(body)
        assert spark.table("staging_companies").columns[0] == "staging_id" and len(spark.catalog.listTables()) == 24
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE made CASCADE")


def test_labels_and_reports():
    assert [logs.command_label(x) for x in (["import", "p"], ["quarantine", "list", "--limit"], ["database", "cleanup", "plans"], ["database", "test"], ["--x"], [])] == ["import", "quarantine-list", "database-cleanup-plans", "database", "cli", "cli"]
    out = io.StringIO()
    report = reporters.Reporter(out)
    report({"event": "dataset_completed", "dataset": "companies", "rows": 1234, "seconds": 61})
    report.close()
    assert out.getvalue() == "dataset completed: companies, 1,234 rows, 1m 1s\n"
    out.isatty = lambda: True
    report = reporters.Reporter(out)
    report({"event": "batch_committed", "batch_rows": 5})
    report({"event": "import_finished", "rows": 5})
    report.close()
    assert "import finished: 5 rows\n" in out.getvalue()
    assert reporters.summary("t", {"rows": 1000, "loaded": [{"dataset": "x", "rows": 2}], "seconds": 1.5}).splitlines() == ["t", "  rows: 1,000", "  loaded:", "    dataset x, rows 2", "  time: 1.5 s"]


def test_heartbeat():
    import time

    events = []
    with api.heartbeat(api.Options(on_progress=events.append), "materialization_dataset_heartbeat", 0.02, dataset="x"):
        time.sleep(0.15)
    n = len(events)
    time.sleep(0.06)
    assert n >= 2 and len(events) == n and events[0]["dataset"] == "x" and json.dumps(events[0])


def test_payload(spark, tmp_path, tree):
    w = Warehouse(spark, str(tmp_path / "w"))
    api.load(w, tree, options())
    row = w.read("import_quarantine").first()
    found = api.quarantine_payload(w, row.id)
    assert found["simples_option_flag"] == "S" and found["simples_option_date"] is None and row.error_message.startswith("Invalid date")

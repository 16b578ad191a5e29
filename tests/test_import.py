"""A whole import over generated files, its resumption, quarantine, cleanup and logs."""

import json

import pytest

from ledgerspark import api, cli, logs, settings
from ledgerspark.sources.files import ValidationError
from ledgerspark.warehouse import Warehouse, label

TEXTS = {
    "Empresas0.csv": '"00000001";"ACME; ""X""";"2062";"49";"1.234,56";"";""\n00000002;BETA;2062;49;10,00;03;\n00000003;;2062;49;1;03;\n\n00000002;BETA 2;9999;49;11,00;03;\n00000004;D;1;49;1,2,3;03;\n',
    "Estabelecimentos0.csv": ";".join(["00000001", "0001", "91", "", "SHOP", "", "20240131", *[""] * 3, "00000000", "6201500", *[""] * 18]) + "\n",
    "Socios0.csv": "00000001;2;ANA;***1**;49;19991231;;;;;5\n00000001;2;ANA;***1**;49;19991231;;;;;5\n",
    "Simples0.csv": "00000001;S;20200101;00000000;N;;\n",
    "Paises.csv": "105;BRASIL\n105;Brasil\n", "Municipios.csv": "1;A\n", "Qualificacoes.csv": "49;Q\n",
    "Naturezas.csv": "2062;N\n", "Cnaes.csv": "6201500;C\n", "Motivos.csv": "0;M\n",
}


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("dump")
    for name, text in TEXTS.items():
        (root / name).write_text(text, encoding="utf-8")
    return root


@pytest.fixture(scope="module")
def imported(spark, tree, tmp_path_factory):
    w, events = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse"))), []
    out = api.run_import(w, str(tree), api.Options(on_progress=events.append))
    return w, out, events


def test_tables(imported):
    w, out, events = imported
    companies = {r.cnpj_root: r for r in w.read("companies").collect()}
    assert set(companies) == {"00000001", "00000002"}
    assert companies["00000001"].company_name == 'ACME; "X"' and str(companies["00000001"].share_capital) == "1234.56" and companies["00000001"].company_size_code == "00"
    assert companies["00000002"].company_name == "BETA 2"  # the last staged
    shop = w.read("establishments").first()
    assert (shop.cnpj_full, shop.branch_type_code, shop.registration_status_code, shop.activity_start_date) == ("00000001000191", "1", "01", None)
    assert w.read("partners").count() == 1 and w.read("simples_options").count() == 1
    assert [tuple(r) for r in w.read("countries").collect()] == [("105", "Brasil")]
    assert {e["event"] for e in events} >= {"import_started", "import_plan_ready", "dataset_completed", "import_finished"}
    assert out["rows"] == 14 and sorted(r.staging_id for r in w.read("staging_companies").collect()) == [1, 2, 4]


def test_quarantine(imported):
    w, _, _ = imported
    assert tuple(api.quarantine_stats(w, dataset="companies")["totals"].first()) == (2, 0, 2)
    rows = api.quarantine_list(w, 1).collect()
    assert len(rows) == 1 and len(api.quarantine_list(w, after_id=rows[0].id).collect()) == 1
    full = api.quarantine_show(w, rows[0].id)
    assert full.row_number == 3 and full.error_message == "Missing required value for company_name." and full.raw_line.startswith("00000003")
    with pytest.raises(LookupError):
        api.quarantine_show(w, 10**12)


def test_again_does_nothing(imported, tree):
    w, _, _ = imported
    out = api.run_import(w, str(tree))
    assert out["rows"] == 0 and {d["step"] for d in out["materialized"]} == {"keep"} and w.read("import_plans").count() == 1


def test_reconcile_and_cleanup(imported, tree):
    w, _, _ = imported
    assert api.clean_final(w, "companies").truncated == ["companies", "simples_options", "partners", "establishments"] and w.read("companies").isEmpty()
    out = api.materialize(w, str(tree), api.Options(reconcile_lookups=True))
    assert {d["step"] for d in out["datasets"]} == {"replay"} and w.read("companies").count() == 2
    assert ("9999", "Imported placeholder legal nature (9999)") in [tuple(r) for r in w.read("legal_natures").collect()]
    assert api.clean_checkpoints(w, "load", "companies").deleted == {"load checkpoints": 1}
    assert api.clean_checkpoints(w, "materialization", plan_id=1).deleted == {"materialization checkpoints": 4}
    assert api.clean_staging(w, "partners").truncated == ["staging_partners"] and w.read("staging_partners").isEmpty()
    assert api.clean_plans(w, plan_id=1).deleted == {"plan files": 10, "materialization checkpoints": 0, "plans": 1}
    for wrong in (lambda: api.clean_plans(w, plan_id=0), lambda: api.clean_staging(w, "countries"), lambda: api.clean_checkpoints(w, "x"), lambda: api.Options(load_batch_size=0)):
        with pytest.raises(ValidationError):
            wrong()


def test_incomplete_tree(spark, tmp_path):
    (tmp_path / "Empresas0.csv").write_text("x\n")
    with pytest.raises(ValidationError, match="Missing dataset"):
        api.load(Warehouse(spark, str(tmp_path / "w")), str(tmp_path))


def test_command_line(spark, tree, tmp_path, monkeypatch, capsys):
    monkeypatch.setenv("LEDGERSPARK_CONFIG", str(tmp_path / "config.json"))
    run = lambda *args: cli.main([*args], spark)
    assert run("validate", str(tree)) == 0 and json.loads(capsys.readouterr().out)["ok"]
    assert run("doctor") == 1 and run("database", "config", "set", str(tmp_path / "w")) == 0 and settings.warehouse_path() == str(tmp_path / "w")
    capsys.readouterr()
    assert run("import", str(tree), "--dataset", "simples_options", "--force", "--logs", str(tmp_path / "logs")) == 0
    assert json.loads(capsys.readouterr().out)["rows"] == 1
    events = [json.loads(x)["event"] for x in (tmp_path / "logs" / "progress.jsonl").read_text().splitlines()]
    assert events[0] == "import_started" and len(list((tmp_path / "logs").glob("*.json"))) == 1
    assert run("quarantine", "stats") == 0 and run("quarantine", "list", "--limit", "0") == 1 and run("schema", "print") == 0
    assert run("database", "cleanup", "plans", "--force") == 0 and run("import", str(tmp_path / "none"), "--force") == 1


def test_no_repeated_split(spark):
    """A filter on what a line is parsed to must not bring the split along once more."""
    from ledgerspark.operators import normalize as N

    lines = spark.createDataFrame([("1;a;b;c;1;2;",)], "value string")
    plan = N.valid(N.dataset_rows(lines, "companies"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 4 and len(plan) < 40_000


def test_logs_and_shapes(tmp_path):
    e = logs.entry({"kind": "row-quarantined", "x": 1}, command="import")
    assert (e["event"], e["kind"], e["level"], e["severity"], e["command"], e["x"]) == ("row_quarantined", "row_quarantined", "warning", "warning", "import", 1)
    assert logs.entry([1])["payload"] == [1] and logs.entry({"level": "debug", "event": "file_failed"})["level"] == "debug"
    assert [logs.size(x) for x in (5, 2048, 20 * 1024, 300 * 1024**2, 5 * 1024**5)] == ["5 B", "2.00 KB", "20.0 KB", "300 MB", "5120 TB"]
    assert [logs.duration(x) for x in (12, 1500, 61_000, 3_661_500)] == ["12 ms", "1.5 s", "1m 1s", "1h 1m 1.5s"]
    assert logs.slug("Import  load!") == "import-load" and logs.middle("a" * 30, 15) == "aaaaaa...aaaaaa"
    assert label("s3a://user:key@bucket/a/lake/") == "bucket/lake" and label("/data/lake") == "local/lake"

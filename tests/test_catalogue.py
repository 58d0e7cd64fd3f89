"""Running a job catalogue: dependency order, modes, skipping completed jobs."""

import datetime as dt
import json
import os

import pytest

from sluice.operators.jobs import Workspace, resolve_mode, run_catalogue
from sluice.session import work_path
from sluice.sources.json_files import read_catalogue

ORDERS_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def write_catalogue(folder):
    os.makedirs(folder, exist_ok=True)
    first = {"tasks": {
        "ExtractOrders": {"type": "extract_load", "dependencies": [], "query": ORDERS_SQL,
                          "target_table": "encounters", "incremental_field": "o_orderdate",
                          "merge_key": ["o_orderkey"], "source_table": "orders"},
        "SegmentSummary": {"type": "summary", "dependencies": ["ExtractOrders", "NotDefined"],
                           "sql": ["SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus"],
                           "target_table": "status_summary", "indexes": ["o_orderstatus"]}}}
    second = {"tasks": {"SegmentSummary": {"type": "summary", "dependencies": ["ExtractOrders"],
                                           "sql": ["SELECT o_orderpriority, count(*) AS n FROM orders "
                                                   "GROUP BY o_orderpriority"],
                                           "target_table": "priority_summary"}}}
    with open(f"{folder}/1.json", "w") as f:
        json.dump(first, f)
    with open(f"{folder}/2.json", "w") as f:
        json.dump(second, f)
    with open(f"{folder}/3.json", "w") as f:
        json.dump({"something_else": 1}, f)


def test_resolve_mode():
    assert resolve_mode() == ("incremental", None)
    assert resolve_mode(full_refresh=True, last_updated=dt.date(2000, 1, 1)) == ("full", None)
    assert resolve_mode(scheduled=True, as_of=dt.date(2001, 8, 2)) == ("incremental", dt.date(2001, 8, 1))
    with pytest.raises(ValueError):
        resolve_mode(full_refresh=True, incremental=True)


def test_run_catalogue_modes_and_skips(spark, tables_small):
    root = work_path(spark, "t-cat")
    folder = root.removeprefix("file:") + "/catalogue"
    write_catalogue(folder)
    cat = read_catalogue(spark, folder)
    ws = Workspace(spark, root, dt.datetime(2001, 8, 2), sources={"orders": tables_small.orders})
    res = run_catalogue(ws, cat, "full")
    assert [r.job for r in res] == ["ExtractOrders", "SegmentSummary"]  # dependency order
    assert all(r.status == "completed" for r in res)
    # The later file's definition won: a priority summary was written.
    assert "o_orderpriority" in ws.target("priority_summary").read().columns
    assert run_catalogue(ws, cat, "full") == []  # completed for this mode: skipped
    res = run_catalogue(ws, cat, "incremental", dt.date(2000, 1, 1))
    assert [r.status for r in res] == ["completed", "completed"]
    assert ws.target("encounters").read().count() == tables_small.orders.count()


def test_sql_file_field_and_force(spark, tables_small):
    from sluice.operators.jobs import run_job
    root = work_path(spark, "t-sqlfile")
    local = root.removeprefix("file:")
    os.makedirs(local, exist_ok=True)
    with open(f"{local}/proc.sql", "w") as f:
        f.write("CREATE OR REPLACE TEMPORARY FUNCTION half_price(d TIMESTAMP_NTZ) RETURNS TABLE (k BIGINT, p DOUBLE) "
                "RETURN SELECT o_orderkey, o_totalprice / 2 FROM orders WHERE o_orderdate > d")
    ws = Workspace(spark, root, dt.datetime(2001, 8, 2), sources={"orders": tables_small.orders})
    run_job(ws, "P", {"type": "procedure", "sql_file": f"{root}/proc.sql"})
    r = run_job(ws, "F", {"type": "flattened", "target_table": "half",
                          "procedure_call": "SELECT * FROM half_price(TIMESTAMP_NTZ'2000-01-01 00:00:00')"})
    assert r.rows > 0
    # SQL text with '/' is plain SQL, not a path.
    run_job(ws, "S", {"type": "summary", "sql": ["SELECT count(*) / 2 AS half_n FROM orders"], "target_table": "s"})
    assert ws.target("s").read().first().half_n == tables_small.orders.count() / 2


def test_parallel_level_keeps_state_consistent(spark, tables_small):
    root = work_path(spark, "t-par")
    folder = root.removeprefix("file:") + "/catalogue"
    os.makedirs(folder, exist_ok=True)
    tasks = {f"Load{n.title()}": {"type": "extract_load", "dependencies": [], "query": f"SELECT * FROM {n}",
                                  "target_table": f"{n}_t"} for n in ("customer", "orders", "part")}
    with open(f"{folder}/1.json", "w") as f:
        json.dump({"tasks": tasks}, f)
    ws = Workspace(spark, root, dt.datetime(2001, 8, 2),
                   sources={n: tables_small.get(n) for n in ("customer", "orders", "part")})
    res = run_catalogue(ws, read_catalogue(spark, folder), "full", workers=3)
    assert sorted(r.job for r in res) == sorted(tasks)
    meta = {r.table_name: r.record_count for r in ws.meta.read().collect()}
    assert meta == {f"{n}_t": tables_small.get(n).count() for n in ("customer", "orders", "part")}
    assert ws.runs.read().count() == 3
    assert ws.meta.current_version() == 1  # one state write for the whole level
    assert run_catalogue(ws, read_catalogue(spark, folder), "full", workers=3) == []


def test_load_job_mixed_row_shapes(spark):
    from sluice.operators.jobs import run_job
    root = work_path(spark, "t-shapes")
    local = root.removeprefix("file:")
    os.makedirs(f"{local}/in", exist_ok=True)
    with open(f"{local}/in/data.json", "w") as f:
        json.dump([{"id": 1, "name": "a"}, [2, "b"], {"id": 3, "name": "c"}], f)
    with open(f"{local}/in/more.json", "w") as f:
        json.dump([[4, "d, with comma"]], f)
    ws = Workspace(spark, root, dt.datetime(2001, 8, 2))
    r = run_job(ws, "LoadShapes", {"type": "load", "source_file": f"{root}/in", "target_table": "t",
                                   "file_schema": "id int, name string", "positional": True})
    assert r.rows == 4
    assert sorted(tuple(x) for x in ws.target("t").read().collect()) == [
        (1, "a"), (2, "b"), (3, "c"), (4, "d, with comma")]


def test_catalogue_keeps_two_target_versions(spark, tables_small):
    from sluice.operators.storage import list_names
    root = work_path(spark, "t-retain")
    folder = root.removeprefix("file:") + "/catalogue"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/1.json", "w") as f:
        json.dump({"tasks": {"LoadOrders": {"type": "extract_load", "query": ORDERS_SQL, "target_table": "o"}}}, f)
    ws = Workspace(spark, root, dt.datetime(2001, 8, 2), sources={"orders": tables_small.orders})
    for _ in range(4):
        run_catalogue(ws, read_catalogue(spark, folder), "full", skip_completed=False)
    versions = sorted(n for n in list_names(spark, ws.target("o").root) if n.startswith("v"))
    assert versions == ["v00000003", "v00000004"]
    assert ws.target("o").read().count() == tables_small.orders.count()


def test_unknown_dependencies_are_reported(spark, tables_small):
    root = work_path(spark, "t-unknown")
    folder = root.removeprefix("file:") + "/catalogue"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/1.json", "w") as f:
        json.dump({"tasks": {"A": {"type": "summary", "dependencies": ["Ghost"],
                                   "sql": ["SELECT count(*) AS n FROM orders"], "target_table": "a"}}}, f)
    ws = Workspace(spark, root, dt.datetime(2001, 8, 2), sources={"orders": tables_small.orders})
    with pytest.warns(UserWarning, match="A->Ghost"):
        res = run_catalogue(ws, read_catalogue(spark, folder), "full")
    assert [r.status for r in res] == ["completed"]


def test_insert_of_empty_input_returns_zero(spark):
    from sluice.operators import metadata as md
    from sluice.operators.sinks import create_database, create_table, insert_columns
    loc = work_path(spark, "t-empty-insert")
    db = "sluice_" + loc.rsplit("-", 1)[-1]
    create_database(spark, db, loc)
    create_table(spark, f"{db}.m", md.META_DDL)
    empty = spark.createDataFrame([], "table_name string, record_count int")
    assert insert_columns(spark, f"{db}.m", empty, ["table_name", "record_count"]) == 0
    assert spark.table(f"{db}.m").count() == 0


def test_command_line_runs_a_catalogue(spark, capsys):
    from sluice import run as cli
    root = work_path(spark, "t-cli")
    folder = root.removeprefix("file:") + "/catalogue"
    write_catalogue(folder)
    args = ["--catalogue", folder, "--sources", "/root/testdata/sf0.001", "--root", f"{root}/ws"]
    assert cli.main(args + ["--full-refresh"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [(x["job"], x["status"], x["mode"]) for x in lines] == [
        ("ExtractOrders", "completed", "full"), ("SegmentSummary", "completed", "full")]
    assert cli.main(args + ["--scheduled", "--as-of", "2001-06-01"]) == 0
    lines = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert lines[0]["watermark"] == "2001-05-31" and lines[0]["mode"] == "incremental"
    with pytest.raises(SystemExit):
        cli.main(args + ["--full-refresh", "--incremental"])

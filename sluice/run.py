"""Command line: run a job catalogue over a folder of parquet source tables.

    python -m sluice.run --catalogue DIR --sources DIR --root DIR
                         [--full-refresh | --incremental | --scheduled]
                         [--last-updated YYYY-MM-DD] [--as-of YYYY-MM-DD] [--workers N]

``--root`` is the shared folder for targets and state tables (defaults to a
folder of the catalogue's own under the warehouse, the same in every run).
Prints one JSON line per job and exits with 1 if one failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import zlib

from sluice.operators.jobs import Workspace, resolve_mode, run_catalogue
from sluice.operators.storage import list_names
from sluice.session import build_session
from sluice.sources.json_files import read_catalogue


def default_root(spark, catalogue: str) -> str:
    """One folder per catalogue, so that a run finds the state of the runs before it."""
    name = zlib.crc32(catalogue.rstrip("/").encode())
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/sluice-{name:08x}"


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="sluice.run")
    p.add_argument("--catalogue", required=True)
    p.add_argument("--sources", required=True, help="folder of <table>.parquet datasets")
    p.add_argument("--root")
    g = p.add_mutually_exclusive_group()
    g.add_argument("--full-refresh", action="store_true")
    g.add_argument("--incremental", action="store_true")
    g.add_argument("--scheduled", action="store_true")
    p.add_argument("--last-updated", type=dt.date.fromisoformat)
    p.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--workers", type=int, default=1)
    p.add_argument("--force", action="store_true", help="re-run jobs already completed for this mode/watermark")
    p.add_argument("--master", help="as the cluster sets it, if not given")
    a = p.parse_args(argv)

    spark = build_session(master=a.master)
    mode, watermark = resolve_mode(a.full_refresh, a.incremental, a.scheduled, a.last_updated, a.as_of)
    sources = {n.removesuffix(".parquet"): spark.read.parquet(f"{a.sources.rstrip('/')}/{n}")
               for n in list_names(spark, a.sources) if n.endswith(".parquet")}
    ws = Workspace(spark, a.root or default_root(spark, a.catalogue), dt.datetime.now(), sources=sources)
    failed = False
    for r in run_catalogue(ws, read_catalogue(spark, a.catalogue), mode, watermark, workers=a.workers,
                           skip_completed=not a.force):
        print(json.dumps({"job": r.job, "status": r.status, "rows": r.rows, "mode": mode,
                          "watermark": str(watermark) if watermark else None} | ({"notes": r.notes} if r.notes else {})))
        failed = failed or r.status in ("failed", "blocked")
    return int(failed)


if __name__ == "__main__":
    raise SystemExit(main())

"""Command line: ``python -m constella <command> --warehouse PATH [...]``.

  setup   create the warehouse tables (idempotent)
  run     one incremental run over a landing folder of page envelopes
  stream  process every new page file with Structured Streaming (availableNow)
  failed  pages that could not be read, with their text
  replay  parse them again and load those that can be read now
  compact rewrite the live batches into one and remove the old directories
  reset   empty every table and the run state (explicit only)
"""

from __future__ import annotations

import argparse
import json

from constella.plans.pipeline import RunOptions, failed_pages, replay_failed, run_landed
from constella.session import build_session
from constella.sources.tables import Warehouse
from constella.streaming import run_stream


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="constella")
    ap.add_argument("command", choices=["setup", "run", "stream", "failed", "replay", "compact", "reset"])
    ap.add_argument("--warehouse", required=True)
    ap.add_argument("--landing")
    ap.add_argument("--limit", type=int, default=50, help="rows per API page")
    ap.add_argument("--multiline", action="store_true", help="one pretty-printed JSON document per file")
    ap.add_argument("--lookback", help="re-admit late rows, e.g. '2 days'")
    ap.add_argument("--date-grain", default="timestamp", choices=["timestamp", "day"])
    ap.add_argument("--compact-every", type=int, help="compact when more batches than this are live")
    ap.add_argument("--catalog-prefix", help="register namespaces/tables in the session catalog")
    ap.add_argument("--master", help="only where none is submitted")
    a = ap.parse_args(argv)

    spark = build_session(master=a.master)
    wh = Warehouse(spark, a.warehouse).setup()
    if a.catalog_prefix is not None:
        wh.register_tables(a.catalog_prefix)
    options = RunOptions(lookback=a.lookback, date_grain=a.date_grain, compact_every=a.compact_every)
    if a.command == "run":
        r = run_landed(wh, a.landing, a.limit, options, a.multiline)
        print(json.dumps(None if r is None else {"batch_id": r.batch_id, "last_date": str(r.last_date),
                                                 "window_rows": r.window_rows,
                                                 "null_date_rows": r.null_date_rows}))
    elif a.command == "stream":
        run_stream(wh, a.landing, options=options, multiline=a.multiline, limit=a.limit)
    elif a.command == "failed":
        failed_pages(wh).show(truncate=False)
    elif a.command == "replay":
        replay_failed(wh, options=options)
    elif a.command == "compact":
        wh.compact()
        wh.vacuum()
    elif a.command == "reset":
        wh.reset()
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())

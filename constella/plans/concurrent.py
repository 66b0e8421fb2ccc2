"""Submit independent Spark actions from several driver threads.

Dimension steps of one batch read the same window and write different
tables; running their jobs concurrently keeps executors busy while each
small job waits on its stage boundaries.  Results are returned by name and
the first failure is re-raised.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context


def run_all(tasks: dict[str, Callable[[], object]], max_workers: int = 8) -> dict[str, object]:
    if len(tasks) <= 1 or max_workers <= 1:
        return {name: fn() for name, fn in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {name: pool.submit(copy_context().run, fn) for name, fn in tasks.items()}
        return {name: f.result() for name, f in futures.items()}

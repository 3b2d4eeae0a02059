"""Run independent Spark actions from a few driver threads.

Spark schedules jobs submitted from several threads side by side, so small
independent jobs (one table write each) overlap instead of queueing.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

DEFAULT_PARALLELISM = 4     # independent models/tables handled at the same time


def run_all(tasks: dict[str, Callable[[], object]], parallelism: int = DEFAULT_PARALLELISM
            ) -> dict[str, object]:
    if parallelism <= 1 or len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}

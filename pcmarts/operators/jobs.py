"""Independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

T = TypeVar("T")

AT_ONCE = 8  # more would only queue up in the scheduler


def side_by_side(jobs: Mapping[str, Callable[[], T]], at_once: int = AT_ONCE) -> dict[str, T]:
    """The results of all jobs, by name and in the order given.

    A short job leaves most cores idle while its last task runs; others fill them. All jobs end before the first failure is raised.
    """
    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(jobs)))) as threads:
        running = {name: threads.submit(job) for name, job in jobs.items()}
    return {name: job.result() for name, job in running.items()}

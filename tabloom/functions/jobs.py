"""Independent Spark jobs submitted together."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor


def side_by_side(jobs: Mapping[str, Callable], parallelism: int = 4) -> dict:
    """Results of jobs that do not depend on each other, by name and in the given order.

    Spark fills free slots of one job with tasks of the next. The first error
    is raised once all jobs have ended.
    """
    with ThreadPoolExecutor(parallelism) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}

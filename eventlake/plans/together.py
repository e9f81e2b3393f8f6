"""Independent steps as concurrent Spark jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

POOL = "spark.scheduler.pool"


def run_together(spark: SparkSession, steps: dict[str, Callable[[], Any]], most: int = 8) -> dict[str, Any]:
    """Run steps at the same time, at most ``most`` of them; what each returns, by name.

    Every step submits its jobs from a thread of its own into a scheduler pool of its name, so with
    ``spark.scheduler.mode=FAIR`` a short step is not queued behind a long one; with FIFO they share what is idle. All jobs of
    the call carry one tag. If a step fails, jobs of the others are cancelled, steps not begun are left out, and the first
    failure is raised. Steps must not write the same table.
    """
    context, tag = spark.sparkContext, f"together-{uuid.uuid4().hex}"
    stopped = []

    def guarded(name: str, step: Callable[[], Any]) -> Any:
        if stopped:
            return None
        context.addJobTag(tag)
        context.setLocalProperty(POOL, name)
        try:
            return step()
        except BaseException:
            stopped.append(name)
            raise
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty(POOL, None)

    if not steps:
        return {}
    with ThreadPoolExecutor(min(most, len(steps))) as pool:
        running = {
            name: pool.submit(inheritable_thread_target(spark)(guarded), name, step) for name, step in steps.items()
        }
        wait(running.values(), return_when=FIRST_EXCEPTION)
        if stopped:
            # a step may be between two jobs; cancel until all have ended
            while wait(running.values(), timeout=0.5).not_done:
                context.cancelJobsWithTag(tag)
    # the step that failed first, not one that was cancelled because of it
    if stopped:
        running[stopped[0]].result()
    return {name: future.result() for name, future in running.items()}

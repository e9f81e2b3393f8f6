"""Steps that run at the same time."""

from __future__ import annotations

import threading
import time

import pytest

from eventlake.plans.together import run_together


def test_steps_overlap_and_keep_their_names(spark):
    both = threading.Barrier(2, timeout=60)

    def step(n):
        def run():
            both.wait()  # passes only if the other step has begun as well
            return spark.range(n).count()

        return run

    assert run_together(spark, {"a": step(3), "b": step(5)}) == {"a": 3, "b": 5}
    assert run_together(spark, {}) == {}


def test_a_failure_cancels_the_others(spark):
    begun, ended = threading.Event(), []

    def endless():
        begun.set()
        try:
            spark.range(10**12).selectExpr("sum(crc32(CAST(id AS STRING)))").collect()
        finally:
            ended.append(True)

    def fails():
        begun.wait(60)
        time.sleep(1)
        raise ValueError("stale")

    start = time.monotonic()
    with pytest.raises(ValueError, match="stale"):
        run_together(spark, {"tests": endless, "freshness": fails})
    assert ended and time.monotonic() - start < 60
    # the caller's own jobs go on
    assert spark.range(4).count() == 4


def test_more_steps_than_threads(spark):
    steps = {str(i): (lambda i=i: spark.range(i).count()) for i in range(5)}
    assert run_together(spark, steps, most=2) == {str(i): i for i in range(5)}

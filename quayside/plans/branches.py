"""Independent branches of a job as concurrent Spark jobs, each with a time limit and retries.

Every branch runs in a thread of its own, its Spark jobs in a scheduler pool of its own name (with
``spark.scheduler.mode=FAIR`` the pools share the cluster evenly) and under a tag by which they are cancelled when its
time is up. One branch that fails or is cancelled does not stop the others.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import InheritableThread
from pyspark.sql import SparkSession

#: Seconds between two cancellations of a branch whose time is up, as it may just be between two Spark jobs.
AGAIN = 0.5


@dataclass
class Outcome:
    """``error`` is None for a branch that succeeded, and a TimeoutError for one whose time was up in its last attempt."""

    value: object = None
    error: Exception | None = None
    attempts: int = 0
    seconds: float = 0.0


def _attempt(spark: SparkSession, name: str, work: Callable[[], object], limit: float | None) -> object:
    context, tag, done, expired = spark.sparkContext, f"{name}-{uuid.uuid4().hex}", threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(limit):
            return
        expired.set()
        while not done.wait(AGAIN):
            context.cancelJobsWithTag(tag)

    context.setLocalProperty("spark.scheduler.pool", name)
    context.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    try:
        value = work()
    except Exception as error:
        if expired.is_set():
            raise TimeoutError(f"{name}: not done after {limit} s") from error
        raise
    finally:
        done.set()
        watcher.join()
        context.removeJobTag(tag)
    return value


def run_branches(
    spark: SparkSession, branches: Mapping[str, Callable[[], object]], limit: float | None = None, retries: int = 0, pause: float = 0.0
) -> dict[str, Outcome]:
    """Runs all branches at the same time and waits for them; ``limit`` seconds and ``retries`` hold for each.

    A limit ends the Spark jobs of an attempt; Python code between them is not interrupted. Branches must be safe to
    run again from the start if there are retries.
    """
    outcomes = {name: Outcome() for name in branches}

    def run(name: str) -> None:
        out, start = outcomes[name], time.monotonic()
        while out.attempts <= retries:
            if out.attempts:
                time.sleep(pause)
            out.attempts += 1
            try:
                out.value, out.error = _attempt(spark, name, branches[name], limit), None
                break
            except Exception as error:  # kept for the caller
                out.error = error
        out.seconds = time.monotonic() - start

    threads = [InheritableThread(target=run, args=(name,), session=spark) for name in branches]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    return outcomes

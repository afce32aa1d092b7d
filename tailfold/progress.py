"""Log lines while a long step runs, from the task counts of its jobs."""

from __future__ import annotations

import contextlib
import logging
import threading
import uuid

from pyspark.sql import SparkSession

LOG = logging.getLogger(__name__)
SECONDS = 2.0


@contextlib.contextmanager
def reported(spark: SparkSession, what: str, units: int, step: int, seconds: float = SECONDS):
    """Log ``what`` whenever another ``step`` of ``units`` are done, judged by finished tasks.

    The jobs of the block run in a job group of their own; a driver thread asks the status tracker.
    Tasks of a stage that has not begun are not known yet, so the share is of what has been submitted.
    """
    context = spark.sparkContext
    group, ended = f"tailfold-{uuid.uuid4().hex}", threading.Event()
    best = 0

    def look() -> None:
        nonlocal best
        tracker = context.statusTracker()
        done = total = 0
        for job in tracker.getJobIdsForGroup(group):
            info = tracker.getJobInfo(job)
            for stage in (tracker.getStageInfo(s) for s in (info.stageIds if info else ())):
                if stage is not None:
                    done, total = done + stage.numCompletedTasks, total + stage.numTasks
        reached = int(units * done / total) // step * step if total else 0
        if reached > best:
            best = reached
            LOG.info("%s: about %d of %d", what, reached, units)

    def watch() -> None:
        while not ended.wait(seconds):
            with contextlib.suppress(Exception):  # the session may be closing
                look()

    context.setJobGroup(group, what)
    thread = threading.Thread(target=watch, daemon=True)
    thread.start()
    try:
        yield
        look()
    finally:
        ended.set()
        thread.join()
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)

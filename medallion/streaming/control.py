"""Waiting for streams and stopping them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def finish(
    query: StreamingQuery, poll_seconds: int = 2, keep: Callable[[dict], None] | None = None
) -> list[dict]:
    """Await a run-once query; returns the progress of every micro-batch.

    Spark remembers only the last 100 progress records, so they are gathered while the query
    runs. ``keep`` gets each as soon as it is seen, those of a failing query too.
    """
    seen: dict[int, dict] = {}

    def gather() -> None:
        for progress in query.recentProgress:
            known = seen.get(progress["batchId"])
            if known is None or progress["numInputRows"] > known["numInputRows"]:
                seen[progress["batchId"]] = progress
                if keep:
                    keep(progress)

    try:
        while not query.awaitTermination(poll_seconds):
            gather()
    finally:
        gather()
    return [seen[batch] for batch in sorted(seen)]


def wait_for_all_streams(spark: SparkSession) -> None:
    """Return when no stream of the session is running; a failed stream raises."""
    while spark.streams.active:
        for query in spark.streams.active:
            query.awaitTermination()


def stop_all_streams(spark: SparkSession) -> int:
    """Stop every stream of the session, whatever state it is in; returns how many."""
    stopped = 0
    for query in spark.streams.active:
        try:
            query.stop()
        except StreamingQueryException:
            pass
        stopped += 1
    return stopped

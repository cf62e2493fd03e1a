"""Start and stop of streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


# How often live progress is refreshed, and how often a log is polled.
REFRESH = "250 milliseconds"
POLL = "2 seconds"


class Runner:
    """One streaming query that is started at most once at a time.

    ``every`` is the pause between micro-batches, as soon as possible if not given.
    ``enabled=False`` makes :meth:`start` do nothing.  A stopped runner stays stopped;
    a new one with the same checkpoint continues where it left off.

    ``ended`` says whether what the query follows has come to its end, as
    :func:`runlens.sources.packedlog.applications_ended` does for event logs; with it
    :meth:`run` stops by itself.
    """

    def __init__(
        self,
        writer: DataStreamWriter,
        checkpoint: str,
        every: str | None = None,
        enabled: bool = True,
        ended: Callable[[], bool] | None = None,
    ):
        self.writer = writer.option("checkpointLocation", checkpoint)
        if every is not None:
            self.writer = self.writer.trigger(processingTime=every)
        self.enabled = enabled
        self.ended = ended
        self.query: StreamingQuery | None = None
        self.stopped = False

    def start(self) -> StreamingQuery | None:
        if self.stopped:
            raise RuntimeError("already stopped")
        if self.enabled and (self.query is None or not self.query.isActive):
            self.query = self.writer.start()
        return self.query

    def stop(self) -> None:
        self.stopped = True
        if self.query is not None:
            self.query.stop()

    def run(self, pause: float = 2.0) -> None:
        """Start, and stop once the end has come and all before it is written.

        What fails the query is raised here.  Ends at once where progress is off.
        """
        query = self.start()
        if query is None:
            return
        while not query.awaitTermination(pause):
            # The end is the last thing written, so all of the rest is there by then.
            if self.ended is not None and self.ended():
                query.processAllAvailable()
                self.stop()
                return


def run_available(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Process what is there now, then stop."""
    query = (
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def run_to_the_end(writer: Callable[[], DataStreamWriter], checkpoint: str) -> int:
    """Run again until a run reads nothing, for sources that stop at a budget; counts runs.

    ``writer`` makes the same query each time; a file that grows all the while is followed
    until it pauses.
    """
    runs = 0
    while True:
        query = run_available(writer(), checkpoint)
        runs += 1
        if not sum(p.numInputRows for p in query.recentProgress):
            return runs

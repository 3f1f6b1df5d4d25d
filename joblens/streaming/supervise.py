"""Running several streaming queries as one (STM4).

The first query to fail takes the others with it, and its error reaches the
caller; queries of the session that are not watched have no say.
"""

from __future__ import annotations

import threading

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class _Ends(StreamingQueryListener):
    """Wakes the waiting thread when any query ends."""

    def __init__(self) -> None:
        self.seen = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.seen.set()


def await_together(spark: SparkSession, queries: list[StreamingQuery], endless: bool = False, poll: float = 5.0) -> None:
    """Wait until all ``queries`` have ended; if one fails, stop the others
    and raise its error.  ``endless`` queries have no end of their own: when
    one is stopped, the others are stopped too.

    ``poll`` (seconds) is a second look in case a listener event is lost."""
    ends = _Ends()
    spark.streams.addListener(ends)
    try:
        while True:
            ends.seen.clear()
            over = [q for q in queries if not q.isActive]
            failed = next((q for q in over if q.exception()), None)
            if failed or (endless and over):
                for q in queries:
                    q.stop()
                if failed:
                    raise failed.exception()
                return
            if len(over) == len(queries):
                return
            ends.seen.wait(poll)
    except BaseException:
        for q in queries:
            q.stop()
        raise
    finally:
        spark.streams.removeListener(ends)

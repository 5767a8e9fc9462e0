"""Progress of long jobs: counters that ride along with a write, and messages of streams."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

log = logging.getLogger("zonekeep")


def counted(rows: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``rows`` and their counter, filled by the first action on them without a job of its own."""
    seen = Observation(name)
    return rows.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def report(seen: Observation, what: str) -> int:
    """The rows that were counted, once the action has ended; also logged."""
    rows = seen.get["rows"]
    log.info("%s: %d rows", what, rows)
    return rows


class StreamProgress(StreamingQueryListener):
    """Rows of each stream so far, logged after every batch that had any."""

    def __init__(self) -> None:
        self.rows: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.rows.setdefault(str(event.runId), 0)

    def onQueryProgress(self, event) -> None:  # noqa: N802
        run = str(event.progress.runId)
        self.rows[run] = self.rows.get(run, 0) + event.progress.numInputRows
        if event.progress.numInputRows:
            log.info("stream %s: batch %d, %d rows so far", run, event.progress.batchId, self.rows[run])

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

"""Backlog of a running stream: events produced but not yet consumed.

The table form is ``operators.delivery.backlog_depth``. Here the stream itself reports: it observes
how many events each micro-batch took, and a listener sets that against what was produced.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from txflow.schemas import BACKLOG_ALERT

_METRIC = "consumed"


def observed(events: DataFrame) -> DataFrame:
    """The same events; Spark counts them on the way, and the listener is told."""
    return events.observe(_METRIC, F.count(F.lit(1)).alias("events"))


@dataclass(frozen=True)
class Depth:
    batch_id: int
    produced: int
    consumed: int
    depth: int
    alert: bool


class BacklogListener(StreamingQueryListener):
    """Keeps the depth after each of the last ``keep`` micro-batches of a query over ``observed`` events,
    and calls ``on_alert`` with each that is above ``alert``.

    ``produced`` tells how many events there have been by now, for instance a producer's own
    counter. ``consumed`` is where a query begins that goes on from a checkpoint. A batch that runs
    again after a failure is counted once. A depth is never below zero: what a producer's
    counter does not show yet is no backlog.
    """

    def __init__(
        self,
        produced: Callable[[], int],
        alert: int = BACKLOG_ALERT,
        on_alert: Callable[[Depth], None] | None = None,
        consumed: int = 0,
        keep: int = 1000,
    ):
        self.produced, self.alert, self.on_alert = produced, alert, on_alert
        self.consumed, self.last_batch = consumed, -1
        self.depths: deque[Depth] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        """Nothing to do."""

    def onQueryIdle(self, event) -> None:
        """Nothing was consumed, but more may have been produced."""
        self._tell(self.last_batch)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        taken = progress.observedMetrics.get(_METRIC)
        if taken is not None and progress.batchId > self.last_batch:
            self.consumed += taken.events
            self.last_batch = progress.batchId
            self._tell(progress.batchId)

    def onQueryTerminated(self, event) -> None:
        """What was kept stays."""

    def _tell(self, batch_id: int) -> None:
        there = self.produced()
        depth = max(0, there - self.consumed)
        now = Depth(batch_id, there, self.consumed, depth, depth > self.alert)
        self.depths.append(now)
        if now.alert and self.on_alert is not None:
            self.on_alert(now)

"""The backlog of a running stream."""

import json
import time

from tests.test_streaming import dirs, feed, recorded  # noqa: F401
from txflow.streaming import backlog
from txflow.streaming import windows as S


def wait_for(listener, batches):
    for _ in range(100):
        if listener.last_batch >= batches - 1:
            return
        time.sleep(0.1)


def test_a_throttled_stream_raises_the_alert_until_it_catches_up(spark, feed, dirs):  # noqa: F811
    out, checkpoint = dirs
    sizes = [700, 800, 600, 900]
    for n in sizes:
        feed.add([json.dumps({"event_id": i, "timestamp": 5.0, "arrival": 5.0}) for i in range(n)] + ["{broken"])
        time.sleep(0.05)
    alerts = []
    listener = backlog.BacklogListener(lambda: sum(sizes), on_alert=alerts.append)
    spark.streams.addListener(listener)
    try:
        S.append_to(backlog.observed(recorded(spark, feed, files_per_batch=1)), out, checkpoint)
        wait_for(listener, 4)
    finally:
        spark.streams.removeListener(listener)
    told = [(d.batch_id, d.consumed, d.depth, d.alert) for d in listener.depths]
    assert told == [(0, 700, 2300, True), (1, 1500, 1500, True), (2, 2100, 900, False), (3, 3000, 0, False)]
    assert [a.batch_id for a in alerts] == [0, 1]

    # The stream goes on from its checkpoint: its listener is told where it begins.
    feed.add([json.dumps({"event_id": 1, "timestamp": 5.0, "arrival": 5.0})])
    later = backlog.BacklogListener(lambda: 3002, consumed=3000, alert=0)
    spark.streams.addListener(later)
    try:
        S.append_to(backlog.observed(recorded(spark, feed, files_per_batch=1)), out, checkpoint)
        wait_for(later, 5)
    finally:
        spark.streams.removeListener(later)
    assert [(d.consumed, d.depth, d.alert) for d in later.depths] == [(3001, 1, True)]


def test_batches_count_once_and_only_so_many_are_kept():
    class Event:
        class progress:  # noqa: N801
            batchId = 4
            observedMetrics = {"consumed": type("R", (), {"events": 5})}

    listener = backlog.BacklogListener(lambda: 3, keep=2)
    for _ in range(3):
        listener.onQueryProgress(Event)
    assert listener.consumed == 5 and [d.depth for d in listener.depths] == [0]
    for _ in range(3):
        listener.onQueryIdle(None)
    assert len(listener.depths) == 2

"""Delivery of messages to jobs, with state: one job of a kind at a time, redelivery after growing waits, dead letters, and an alert
for messages that nobody has acknowledged.

Both are stateful operators over event time: the clock is the stream's watermark, so that a run that is behind, or is run again,
decides as it would have done then. Their state is one entry an open message, kept by job or subscription in the state store, and
is gone when the message is acknowledged or dead. The rows of one key in one micro-batch are put in order in memory, so that what is
decided does not hang on where batches are cut; the source's rate bounds them. A session needs the RocksDB state store (`with_state_store`).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Seconds between deliveries, deliveries in all, and the age from which a message counts as stuck.
FIRST_WAIT, LONGEST_WAIT = 10, 600
DELIVERIES = 5
STUCK_SECONDS = 3600

DELIVERED = "job string, message_id string, argument string, action string, delivery int, at timestamp, error string"
STUCK = "subscription string, message_id string, published timestamp, at timestamp"


def with_state_store(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def wait_after(delivery: int) -> int:
    """Seconds until the next delivery after the given one."""
    return min(LONGEST_WAIT, FIRST_WAIT * 2 ** (delivery - 1))


def _ms(at) -> int:
    return int(pd.Timestamp(at).value // 1_000_000)


class Dispatcher(StatefulProcessor):
    """Of one job: what runs, and what waits for its next delivery.

    Rows are messages (kind 'message': message_id, argument) and what became of a start (kind 'finished', or 'failed' with an error, of
    a message_id). A message that finds the job busy, or whose start fails, is delivered again later; after DELIVERIES it is dead.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.running = handle.getValueState("running", "message_id string, argument string, delivery int")
        self.waiting = handle.getMapState("waiting", "message_id string", "argument string, delivery int, due long")

    def _row(self, job, message, argument, action, delivery, at, error=None) -> tuple:
        return job, message, argument, action, delivery, pd.Timestamp(at, unit="ms"), error

    def _again(self, job, message, argument, delivery, at, error) -> tuple:
        if delivery >= DELIVERIES:
            return self._row(job, message, argument, "dead_letter", delivery, at, error)
        due = at + 1000 * wait_after(delivery)
        self.waiting.updateValue((message,), (argument, delivery, due))
        self.handle.registerTimer(due)
        return self._row(job, message, argument, "retry", delivery, at, error)

    def _deliver(self, job, message, argument, delivery, at) -> tuple:
        if self.running.exists():
            return self._again(job, message, argument, delivery, at, "busy")
        self.running.update((message, argument, delivery))
        return self._row(job, message, argument, "start", delivery, at)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        frame = pd.concat(list(rows))
        # What ends comes before what begins at the same moment.
        for r in frame.assign(last=frame["kind"] == "message").sort_values(["at", "last", "message_id"], kind="stable").itertuples():
            out += self._overdue(key[0], _ms(r.at) - 1)
            if r.kind == "message":
                if not self.waiting.containsKey((r.message_id,)):  # a second copy of what waits changes nothing
                    out.append(self._deliver(key[0], r.message_id, r.argument, 1, _ms(r.at)))
                continue
            now = self.running.get() if self.running.exists() else None
            if now is not None and now[0] == r.message_id:
                self.running.clear()
                if r.kind == "failed":
                    out.append(self._again(key[0], now[0], now[1], int(now[2]), _ms(r.at), r.error))
        yield pd.DataFrame(out, columns=_names(DELIVERED))

    def _overdue(self, job, until: int) -> list[tuple]:
        """Deliveries that are due up to a moment, one after another, as their timers would make them."""
        out = []
        while True:
            due = sorted((v[2], k[0], v[0], int(v[1])) for k, v in self.waiting.iterator() if v[2] <= until)
            if not due:
                return out
            at, message, argument, delivery = due[0]
            self.waiting.removeKey((message,))
            out.append(self._deliver(job, message, argument, delivery + 1, at))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame(self._overdue(key[0], expiredTimerInfo.getExpiryTimeInMs()), columns=_names(DELIVERED))

    def close(self) -> None:
        pass


class OpenMessages(StatefulProcessor):
    """Of one subscription: when each open message was published. A row of kind 'published' opens, 'acknowledged' closes."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getMapState("open", "message_id string", "published long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        out = []
        frame = pd.concat(list(rows))
        opened: dict[str, int] = {}  # in this batch, and still open: only these go to the state
        for r in frame.assign(last=frame["kind"] != "published").sort_values(["at", "last"], kind="stable").itertuples():
            if r.kind == "published":
                opened[r.message_id] = _ms(r.at)
                continue
            published = opened.pop(r.message_id, None)
            if published is None and self.open.containsKey((r.message_id,)):
                published = self.open.getValue((r.message_id,))[0]
                self.open.removeKey((r.message_id,))
            if published is not None and _ms(r.at) > published + 1000 * STUCK_SECONDS:  # the alert was due before
                out.append(self._alert(key[0], r.message_id, published))
        for message, published in opened.items():
            self.open.updateValue((message,), (published,))
            self.handle.registerTimer(published + 1000 * STUCK_SECONDS)
        yield pd.DataFrame(out, columns=_names(STUCK))

    def _alert(self, subscription, message, published) -> tuple:
        return subscription, message, pd.Timestamp(published, unit="ms"), pd.Timestamp(published + 1000 * STUCK_SECONDS, unit="ms")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """An alert for each message that is open for so long; it stays open, but is said once."""
        before = expiredTimerInfo.getExpiryTimeInMs() - 1000 * STUCK_SECONDS
        due = [(k[0], v[0]) for k, v in self.open.iterator() if v[0] <= before]
        for message, _ in due:
            self.open.removeKey((message,))
        yield pd.DataFrame([self._alert(key[0], m, p) for m, p in sorted(due)], columns=_names(STUCK))

    def close(self) -> None:
        pass


def _names(schema: str) -> list[str]:
    return [c.split(" ")[0] for c in schema.split(", ")]


def dispatched(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """What is done with the messages of a stream (job, kind, message_id, argument, error, at): DELIVERED rows with action start,
    retry or dead_letter. The state of a job is in one place; jobs are spread over tasks."""
    e = events.select("job", "kind", "message_id", "argument", "error", "at").withWatermark("at", late)
    return e.groupBy("job").transformWithStateInPandas(Dispatcher(), outputStructType=DELIVERED, outputMode="append", timeMode="eventTime")


def stuck(events: DataFrame, late: str = "0 seconds") -> DataFrame:
    """Messages of a stream (subscription, kind, message_id, at) that were open for longer than STUCK_SECONDS, when they were."""
    e = events.select("subscription", "kind", "message_id", "at").withWatermark("at", late)
    return e.groupBy("subscription").transformWithStateInPandas(OpenMessages(), outputStructType=STUCK, outputMode="append", timeMode="eventTime")


# Spark starts Python processes beside the driver for this, which do not have the files that are sent to executors: what they need
# is sent by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

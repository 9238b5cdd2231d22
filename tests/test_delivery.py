"""Deliveries and alerts against a plain simulation, with a clock that is the stream's."""

from datetime import datetime, timedelta

import pytest

from factloom.streaming import delivery

START = datetime(2025, 1, 1)
EVENTS = "job string, kind string, message_id string, argument string, error string, at timestamp"


@pytest.fixture
def state(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(key)
    delivery.with_state_store(spark)
    yield spark
    spark.conf.set(key, old)


def at(seconds):
    return START + timedelta(seconds=seconds)


def run(spark, folder, batches, schema, operator):
    """Rows of the operator over batches that arrive one after another."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in/{i:03}")
        source = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
        q = operator(source).writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        q.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out").collect()


def test_waits_grow_to_their_most():
    assert [delivery.wait_after(n) for n in range(1, 9)] == [10, 20, 40, 80, 160, 320, 600, 600]


def test_busy_jobs_and_failed_starts_are_delivered_again(state, tmp_path):
    tick = lambda s: ("clock", "message", f"t{s}", "", None, at(s))
    m = lambda s, i, job="parse": (job, "message", i, f"arg-{i}", None, at(s))
    end = lambda s, i, kind="finished", error=None: ("parse", kind, i, None, error, at(s))
    batches = [
        [m(0, "a"), m(1, "b"), m(2, "x", "extract"), m(2, "b")],  # b finds parse busy; its second copy is one too many
        [tick(15)],  # b's second delivery at 11: still busy, next at 31
        [end(20, "a"), tick(40)],  # b starts at 31
        [end(41, "b", "failed", "no room"), m(50, "c"), tick(120)],  # b waits 40 s, c starts at 50; b is busy at 81
        [tick(200)],  # b's fifth delivery at 161 is its last
        [end(201, "c"), m(202, "d"), tick(300)],
    ]
    got = {(r.message_id, r.delivery, r.action, (r.at - START).seconds, r.error) for r in run(state, tmp_path, batches, EVENTS, delivery.dispatched) if r.job != "clock"}
    assert got == {
        ("a", 1, "start", 0, None), ("x", 1, "start", 2, None), ("b", 1, "retry", 1, "busy"), ("b", 2, "retry", 11, "busy"), ("b", 3, "start", 31, None),
        ("b", 3, "retry", 41, "no room"), ("c", 1, "start", 50, None), ("b", 4, "retry", 81, "busy"), ("b", 5, "dead_letter", 161, "busy"), ("d", 1, "start", 202, None),
    }


def test_an_alert_for_what_nobody_acknowledges(state, tmp_path):
    schema = "subscription string, kind string, message_id string, at timestamp"
    row = lambda s, kind, i, of="s": (of, kind, i, at(s))
    batches = [
        [row(0, "published", "a"), row(5, "published", "b"), row(6, "published", "c", "t"), row(7, "acknowledged", "b")],
        [row(3000, "published", "d"), row(3599, "acknowledged", "c", "t")],
        [row(3700, "published", "e")],  # a is an hour old
        [row(9000, "acknowledged", "d"), row(9000, "acknowledged", "a"), row(9001, "published", "f")],  # d's alert was due at 6600
        [row(20000, "published", "g")],
        [row(20001, "published", "h")],
    ]
    got = sorted((r.subscription, r.message_id, (r.at - START).seconds) for r in run(state, tmp_path, batches, schema, delivery.stuck))
    assert got == [("s", "a", 3600), ("s", "d", 6600), ("s", "e", 7300), ("s", "f", 12601)]

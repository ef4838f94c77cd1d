"""Streaming jobs: late and repeated events."""

import json
import os
import time

from pyspark.sql import functions as F

from mercato.plans.orders import payment_status
from mercato.streaming import events as stream


def write(folder, *batches):
    """One file per batch, in this order of modification time."""
    folder.mkdir(parents=True)
    now = time.time() - 1000
    for i, rows in enumerate(batches):
        path = folder / f"{i}.json"
        path.write_text("\n".join(json.dumps(r) for r in rows))
        os.utime(path, (now + i, now + i))
    return str(folder)


def event(event_id, at, kind="PAYMENT_CAPTURED", order_id="o1"):
    return dict(event_id=event_id, event_type=kind, occurred_at_utc=at, order_id=order_id, payment_id="p", amount=1)


def test_copies_within_the_delay_drop_out_and_too_late_rows_are_lost(spark, tmp_path):
    batches = [
        [event("a", "2026-07-01T00:00:00Z"), event("b", "2026-07-02T00:00:00Z")],
        [event("a", "2026-07-01T00:00:00Z"), event("c", "2026-07-20T00:00:00Z")],
        [event("d", "2026-07-18T00:00:00Z")],
        [event("late", "2026-07-03T00:00:00Z"), event("c", "2026-07-20T00:00:00Z")],
    ]
    out = str(tmp_path / "out")
    stream.deduplicate(spark, write(tmp_path / "in", *batches), out, str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    got = sorted(r["event_id"] for r in spark.read.schema(stream.EVENT_SCHEMA).parquet(out).collect())
    assert got == ["a", "b", "c", "d"]


def test_status_is_the_same_for_any_order_of_arrival(spark, tmp_path):
    rows = [
        [event("1", "2026-07-01T00:00:00Z", "PAYMENT_AUTHORIZED"), event("9", "2026-07-01T00:00:00Z", "PAYMENT_AUTHORIZED", "o2")],
        [event("3", "2026-07-09T00:00:00Z", "PAYMENT_FAILED")],
        [event("2", "2026-07-02T00:00:00Z"), event("2", "2026-07-02T00:00:00Z")],
    ]
    answers = []
    for name, order in (("x", (0, 1, 2)), ("y", (2, 1, 0))):
        out = str(tmp_path / f"out-{name}")
        folder = write(tmp_path / f"in-{name}", *[rows[i] for i in order])
        stream.upsert_status(spark, folder, out, str(tmp_path / f"state-{name}"), files_per_batch=1).awaitTermination()
        answers.append({tuple(r) for r in stream.current_status(spark, out).collect()})
        stream.compact(spark, out, str(tmp_path / f"small-{name}"))
        assert {tuple(r) for r in stream.current_status(spark, str(tmp_path / f"small-{name}")).collect()} == answers[-1]
    batch = spark.read.schema(stream.EVENT_SCHEMA).json(str(tmp_path / "in-x"))
    assert answers[0] == answers[1] == {tuple(r) for r in payment_status(batch).collect()}
    assert ("o1", "PAYMENT_FAILED") in answers[0]


def test_resumed_job_reads_only_new_files(spark, tmp_path):
    folder = write(tmp_path / "in", [event("1", "2026-07-01T00:00:00Z", "PAYMENT_AUTHORIZED")])
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    stream.upsert_status(spark, folder, out, state).awaitTermination()
    (tmp_path / "in" / "new.json").write_text(json.dumps(event("2", "2026-07-02T00:00:00Z")))
    stream.upsert_status(spark, folder, out, state).awaitTermination()
    stored = spark.read.schema(stream.LATEST).parquet(f"{out}/changes")
    assert stored.count() == 2
    assert stream.current_status(spark, out).select(F.first("payment_status")).head()[0] == "PAYMENT_CAPTURED"

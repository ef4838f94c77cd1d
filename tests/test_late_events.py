"""Event ingest that keeps late records: nothing is lost, nothing stands twice."""

import random
import shutil
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from mercato.streaming import late
from test_streaming import event, write


def stamp(at):
    return at.strftime("%Y-%m-%dT%H:%M:%SZ")


def found(spark, out):
    return sorted((r["event_id"], r["late"]) for r in late.all_events(spark, out).collect())


BATCHES = [
    [event("a", "2026-07-01T00:00:00Z"), event("b", "2026-07-02T00:00:00Z")],
    [event("a", "2026-07-01T00:00:00Z"), event("c", "2026-07-20T00:00:00Z")],
    [event("d", "2026-07-18T00:00:00Z"), event("late", "2026-07-03T00:00:00Z"), event("late", "2026-07-03T00:00:00Z")],
    [event("late", "2026-07-03T00:00:00Z"), event("b", "2026-07-02T00:00:00Z"), event("c", "2026-07-20T00:00:00Z"), event("older", "2020-01-01T00:00:00Z")],
    [event("older", "2020-01-01T00:00:00Z"), event("no time", None), event(None, "2026-07-19T00:00:00Z"), event(None, "2026-07-19T00:00:00Z")],
    [event("no time", None), event(None, "2026-07-19T00:00:00Z"), event("e", "2026-08-01T00:00:00Z")],
]
WANTED = sorted([("a", False), ("b", False), ("c", False), ("d", False), ("late", True), ("older", True), ("no time", True), (None, False), ("e", False)], key=repr)


def test_late_rows_are_kept_once(spark, tmp_path):
    out = str(tmp_path / "out")
    query = late.ingest(spark, write(tmp_path / "in", *BATCHES), out, str(tmp_path / "state"), files_per_batch=1)
    query.awaitTermination()
    assert sorted(((r["event_id"], r["late"]) for r in late.all_events(spark, out).collect()), key=repr) == WANTED
    # the stored watermark is the one the query itself reports for the next batch
    reported = [p["eventTime"].get("watermark") for p in query.recentProgress if p["numInputRows"]]
    stored = [spark.read.parquet(f"{out}/watermark/batch_id={n}").head()["newest"] - timedelta(days=7) for n in range(len(BATCHES) - 1)]
    assert [r[:19] for r in reported[1:]] == [s.strftime("%Y-%m-%dT%H:%M:%S") for s in stored]


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    folder, out = write(tmp_path / "in", *BATCHES), str(tmp_path / "out")
    late.ingest(spark, folder, out, str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    commits = tmp_path / "state" / "commits"
    shutil.move(commits / "5", tmp_path / "moved")  # as if the driver had died between the tables and the commit
    (commits / ".5.crc").unlink()
    late.ingest(spark, folder, out, str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    assert sorted(((r["event_id"], r["late"]) for r in late.all_events(spark, out).collect()), key=repr) == WANTED


def test_resumed_job_knows_the_watermark_and_old_ids(spark, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for n, rows in enumerate(BATCHES):
        folder = write(tmp_path / f"in{n}", rows)
        (tmp_path / "in").mkdir(exist_ok=True)
        shutil.copy(f"{folder}/0.json", tmp_path / "in" / f"{n}.json")
        late.ingest(spark, str(tmp_path / "in"), out, state, period="month").awaitTermination()
    assert sorted(((r["event_id"], r["late"]) for r in late.all_events(spark, out).collect()), key=repr) == WANTED


def test_random_feeds_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    start, batches, seen, newest, want = datetime(2026, 1, 1), [], {}, None, {}
    for n in range(6):
        rows = []
        for i in range(40):
            at = start + timedelta(days=10 * n + rng.randrange(10) - (rng.randrange(60) if rng.random() < 0.2 else 0))
            rows.append(event(f"{n}-{i}", stamp(at)))
        rows += rng.choices([r for b in batches for r in b] or rows, k=15)
        batches.append(rows)
    for rows in batches:
        times = {r["event_id"]: datetime.strptime(r["occurred_at_utc"], "%Y-%m-%dT%H:%M:%SZ") for r in rows}
        for key, at in times.items():
            if key not in seen:
                seen[key] = True
                want[key] = newest is not None and at < newest - timedelta(days=7)
        newest = max([*times.values(), *([newest] if newest else [])])
    out = str(tmp_path / "out")
    late.ingest(spark, write(tmp_path / "in", *batches), out, str(tmp_path / "state"), period="week", files_per_batch=1).awaitTermination()
    assert found(spark, out) == sorted(want.items()) and any(want.values())


def test_copies_are_sought_in_their_own_periods_only(spark, tmp_path):
    out = str(tmp_path / "out")
    late.ingest(spark, write(tmp_path / "in", *BATCHES), out, str(tmp_path / "state"), files_per_batch=1).awaitTermination()
    rows = late.stored(spark, out, late.ONTIME).filter(F.col("period").isin([datetime(2026, 7, 20).date()]))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "DataFilters: []" in plan

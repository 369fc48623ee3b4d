"""A stream with repeated and late rows, taken in over several batches, against the batch operators."""

import datetime as dt

import rows
from ledgerloom.operators import quarantine, subscriptions
from ledgerloom.streaming import intake, staging

AS_OF = dt.datetime(2023, 12, 31, tzinfo=rows.UTC)


def created(n, day, cents=1000, raw=None, brand="BRD-000001", at=True):
    return (n, raw or f"evt-{n}", brand, "subscription_created", f"plan {n % 4}", "monthly", cents, day if at else None, not at)


BATCHES = [
    [created(1, "2023-01-01"), created(2, "2023-01-02"), created(3, "2023-01-05", brand=None), created(4, "2023-01-09", brand="BRD-GHOST")],
    # Delivered again while remembered, a newer copy of event 2, and a row without time twice.
    [created(2, "2023-01-02"), created(5, "2023-01-06", 900, raw="evt-2"), created(6, "2023-01-20"), created(7, None, at=False), created(7, None, at=False)],
    # Far too late: one unknown row, one known one, an unknown row of an unknown brand.
    [created(8, "2023-01-03", 700), created(1, "2023-01-01"), created(9, "2023-01-02", brand="BRD-GHOST"), created(10, "2023-03-01")],
    [created(8, "2023-01-03", 700), created(10, "2023-03-01"), created(11, "2023-02-27", raw="evt-10")],
    [],
]


def test_replay_over_batches_equals_the_batch_rule(spark, tmp_path):
    arriving, out, checkpoint = (str(tmp_path / n) for n in ("arriving", "out", "checkpoint"))
    dropped, kept = 0, []
    for batch in BATCHES:
        rows.events(spark, batch).coalesce(1).write.mode("append").parquet(arriving)
        query = staging.start_staging(intake.event_stream(spark, arriving), out, checkpoint, "7 days")
        query.awaitTermination()
        for progress in query.recentProgress:
            for state in progress["stateOperators"]:
                dropped += state["numRowsDroppedByWatermark"]
                kept.append(state["numRowsTotal"])
    distinct = {r[0]: r for batch in BATCHES for r in batch}
    every = rows.events(spark, list(distinct.values()))
    brands = rows.brands(spark, 1)

    assert rows.plain(staging.taken_in(spark, out)) == rows.plain(every)
    assert {r["event_id"] for r in staging.late_events(spark, out).collect()} == {8, 9}
    assert {r["event_id"] for r in staging.taken_in(spark, out, with_late=False).collect()} == set(distinct) - {8, 9}
    assert rows.plain(subscriptions.dedup_events(staging.taken_in(spark, out))) == rows.plain(subscriptions.dedup_events(every))
    staged = subscriptions.stage_subscriptions(subscriptions.resolved_events(every, brands, AS_OF))
    assert rows.plain(staging.staged_subscriptions(spark, out, brands, AS_OF)) == rows.plain(staged)
    assert rows.plain(staging.unmatched(spark, out, brands)) == rows.plain(quarantine.unmatched_events(every, brands))
    # The store forgets what the watermark has passed.
    assert dropped >= 3 and max(kept) >= 4 and kept[-1] <= 2


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    arriving, out = str(tmp_path / "arriving"), str(tmp_path / "out")
    rows.events(spark, BATCHES[0]).write.parquet(arriving)
    for attempt in range(2):  # another checkpoint: the same rows come as a new batch 0
        staging.start_staging(intake.event_stream(spark, arriving), out, str(tmp_path / f"checkpoint{attempt}")).awaitTermination()
    assert rows.plain(staging.taken_in(spark, out)) == rows.plain(rows.events(spark, BATCHES[0]))
    assert staging.late_events(spark, out).count() == 0


def test_no_rows(spark, tmp_path):
    arriving, out = str(tmp_path / "arriving"), str(tmp_path / "out")
    rows.events(spark, []).write.parquet(arriving)
    staging.start_staging(intake.event_stream(spark, arriving), out, str(tmp_path / "checkpoint")).awaitTermination()
    assert staging.taken_in(spark, out).count() == 0
    assert staging.staged_subscriptions(spark, out, rows.brands(spark, 1), AS_OF).count() == 0

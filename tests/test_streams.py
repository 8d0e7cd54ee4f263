"""Streams: restart, redelivery, late events and a repeated micro-batch."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakepnl.session import new_folder
from lakepnl.streaming import router

EVENTS = "seq bigint, pk string, sk string, layer string, status string"


def events(spark, *rows):
    return spark.createDataFrame([(s, "p", "r", layer, st) for s, layer, st in rows], EVENTS)


def test_late_events_find_their_place(spark):
    folder, out, checkpoint = (new_folder(spark, n) for n in "eoc")

    def deliver(*rows, retained=router.RETAINED):
        events(spark, *rows).write.mode("append").parquet(folder)
        router.start_transitions(spark, folder, out, checkpoint, retained=retained).awaitTermination()
        return sorted(r["seq"] for r in router.read_transitions(spark, out).collect())

    first = [(1, "raw", "PENDING"), (2, "raw", "SUCCEEDED"), (2, "raw", "SUCCEEDED"), (3, "gold", "succeeded")]
    assert deliver(*first) == [2, 3]
    # Still succeeded, then failed and succeeded again in a later batch.
    assert deliver((4, "raw", "SUCCEEDED"), (5, "gold", "FAILED")) == [2, 3]
    assert deliver((9, "gold", "SUCCEEDED"), (10, "gold", "SUCCEEDED")) == [2, 3, 9]
    # Delivered again; and with what came late, 8 was the transition and not 9.
    assert deliver((9, "gold", "SUCCEEDED"), (7, "gold", "FAILED"), (8, "gold", "SUCCEEDED")) == [2, 3, 8]
    # A late failure between two successes makes the second one a transition.
    assert deliver((3, "raw", "FAILED"), (11, "gold", None), (12, "gold", "SUCCEEDED")) == [2, 3, 4, 8, 12]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.booleans()), max_size=60), st.integers(1, 9))
def test_any_order_of_events_gives_the_transitions_of_the_log(rows, size):
    log = dict(rows)  # one status for each sequence
    state, net = (np.zeros(0, np.int64), np.zeros(0, bool), None, False), set()
    for at in range(0, len(rows), size):
        some = rows[at : at + size]
        seq = np.array([s for s, _ in some], np.int64)
        state, added, removed = router.merge_events(state, seq, np.array([log[s] for s, _ in some]), 1000)
        assert not net & set(added.tolist()) and set(removed.tolist()) <= net
        net = net | set(added.tolist()) - set(removed.tolist())
        net -= set(removed.tolist())
    order = sorted(log)
    assert net == {s for i, s in enumerate(order) if log[s] and not (i and log[order[i - 1]])}


def test_state_is_bounded_and_what_is_before_it_is_settled():
    state = (np.zeros(0, np.int64), np.zeros(0, bool), None, False)
    state, added, _ = router.merge_events(state, np.arange(100), np.arange(100) % 2 == 1, 10)
    assert len(added) == 50 and state[0].tolist() == list(range(90, 100)) and state[2:] == (89, True)
    state, added, removed = router.merge_events(state, np.array([50, 89, 200]), np.array([True, False, True]), 10)
    # 200 follows a success, and what lies before the state changes nothing.
    assert not len(added) and not len(removed) and state[0].tolist() == [*range(91, 100), 200]


def test_known_changes_expire_by_time_and_new_ones_never_come_too_late(spark):
    feed, out, checkpoint = (new_folder(spark, n) for n in "foc")

    def deliver(day, seq):
        image = f"named_struct('pk', 'PIPE#reporting#prod#BDATE#{day}', 'sk', 'RUN#b', 'business_date', '{day}', 'layers', "
        done = image + "map('raw', named_struct('status', 'SUCCEEDED')))"
        before = image + "map('raw', named_struct('status', 'FAILED')))"
        row = spark.sql(f"SELECT {seq}L AS seq, 'MODIFY' AS event_name, {done} AS new_image, {before} AS old_image")
        row.write.mode("append").parquet(feed)
        router.start_router(spark, feed, out, checkpoint, known_days=30).awaitTermination()
        return sorted((r["business_date"], r["seq"]) for r in router.read_requests(spark, out).select("business_date", "seq").collect())

    today = str(spark.range(1).select(F.current_date()).first()[0])
    future = str(spark.range(1).select(F.date_add(F.current_date(), 100)).first()[0])
    assert deliver(today, 1) == [(today, 1)]
    # Far in the past and still new; again, and it is known.
    assert deliver("2001-02-03", 2) == deliver("2001-02-03", 2) == [("2001-02-03", 2), (today, 1)]
    assert deliver(today, 1) == [("2001-02-03", 2), (today, 1)]
    assert deliver("not a date", 3) == [("2001-02-03", 2), (today, 1), ("not a date", 3)]
    assert len(deliver(future, 4)) == 4 and len(deliver(future, 4)) == 4


def test_router_drops_a_redelivered_change(spark):
    feed, out, checkpoint = (new_folder(spark, n) for n in "foc")
    rows = spark.sql(
        """SELECT 1L AS seq, 'MODIFY' AS event_name,
             named_struct('pk', 'PIPE#reporting#prod#BDATE#2024-01-01', 'sk', 'RUN#b', 'business_date', '',
               'layers', map('lake_standardized_to_silver', named_struct('status', 'succeeded'),
                             'raw', named_struct('status', 'SUCCEEDED'), 'gold', named_struct('status', 'SUCCEEDED'))) AS new_image,
             named_struct('pk', 'x', 'sk', 'RUN#b', 'business_date', '',
               'layers', map('raw', named_struct('status', 'SUCCEEDED'))) AS old_image"""
    )
    for _ in range(2):
        rows.write.mode("append").parquet(feed)
        router.start_router(spark, feed, out, checkpoint).awaitTermination()
    (request,) = router.read_requests(spark, out).collect()
    assert (request["project"], request["environment"]) == ("reporting", "prod")
    assert (request["target"], request["business_date"], request["batch_id"]) == ("copy", "2024-01-01", "b")
    # A known key is a lookup in the state store: no stored request is read.
    plan = router.requests_of(router.read_feed(spark, feed))._jdf.queryExecution().logical().toString()
    assert "DeduplicateWithinWatermark" in plan and "Join" not in plan
    assert request["execution_name"].startswith("cp-2024-01-01-b-") and len(request["execution_name"]) == 32

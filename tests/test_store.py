import datetime as dt
import math

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shelfrank.session import fresh_path
from shelfrank.streaming import freshness
from shelfrank.streaming.store import Conflict, SnapshotStore, SumStore, VersionLog


def lists(spark, data):
    return spark.createDataFrame(data, "user_id long, book_id long, rank int")


def test_a_version_is_added_once(spark):
    log = VersionLog(spark, fresh_path(spark, "log"))
    assert log.read() == (0, {})
    log.commit(1, {"a": "ü"})
    with pytest.raises(Conflict):
        log.commit(1, {"a": 2})
    assert log.read() == (1, {"a": "ü"}) and log.numbers() == [1]
    log.commit(2, {"a": 3})
    assert log.read() == (2, {"a": 3}) and log.read(1)[1] == {"a": "ü"}


def test_stale_users_are_replaced_and_the_others_stay(spark):
    store = SnapshotStore(spark, fresh_path(spark, "store"))
    with pytest.raises(ValueError):
        store.read()
    with pytest.raises(ValueError):
        store.replace(lists(spark, []), lists(spark, []))
    assert store.publish(lists(spark, [(1, 10, 1), (1, 11, 2), (2, 20, 1), (3, 30, 1)])) == 1
    before = store.read()
    users = spark.createDataFrame([(1,), (3,), (9,), (1,)], "user_id long")
    assert store.replace(lists(spark, [(1, 12, 1), (9, 90, 1)]), users) == 2
    # who opened the store before goes on reading what was there
    assert rows(before) == [(1, 10, 1), (1, 11, 2), (2, 20, 1), (3, 30, 1)]
    assert rows(store.read()) == [(1, 12, 1), (2, 20, 1), (9, 90, 1)]
    store.replace(lists(spark, [(3, 31, 1), (1, 13, 1)]), spark.createDataFrame([(1,), (3,)], "user_id long"))
    want = [(1, 13, 1), (2, 20, 1), (3, 31, 1), (9, 90, 1)]
    assert rows(store.read()) == want and rows(store.read(1)) == rows(before)
    number = store.compact()
    assert number == 4 and rows(store.read()) == want and store.compact() == 4
    store.vacuum(1)
    assert store.log.numbers() == [4] and rows(store.read()) == want
    assert store.publish(lists(spark, [(5, 1, 1)])) == 5 and rows(store.read()) == [(5, 1, 1)]


def test_many_replacements_are_compacted(spark):
    store = SnapshotStore(spark, fresh_path(spark, "store"), most_layers=3)
    store.publish(lists(spark, [(u, 0, 1) for u in range(6)]))
    for k in range(1, 6):
        store.replace(lists(spark, [(k, k, 1)]), lists(spark, [(k, 0, 0)]))
        assert len(store._layers()[1]) <= 3
    assert rows(store.read()) == [(u, u, 1) for u in range(6)]


def test_a_writer_that_comes_second_adds_the_next_version(spark, monkeypatch):
    root = fresh_path(spark, "store")
    one, two = SnapshotStore(spark, root), SnapshotStore(spark, root)
    one.publish(lists(spark, [(1, 1, 1), (2, 2, 1)]))
    read, late = two.log.read, []

    def slow(number=None):
        found = read(number)
        if not late:
            late.append(1)
            one.replace(lists(spark, [(1, 7, 1)]), lists(spark, [(1, 0, 0)]))
        return found

    monkeypatch.setattr(two.log, "read", slow)
    assert two.replace(lists(spark, [(2, 8, 1)]), lists(spark, [(2, 0, 0)])) == 3
    assert rows(one.read()) == [(1, 7, 1), (2, 8, 1)]


def test_runs_stay_few_and_sums_whole(spark):
    store = SumStore(spark, fresh_path(spark, "sums"), ["k"], "v", fanout=2)
    assert store.read() is None
    for n in range(11):
        store.add(spark.createDataFrame([(n % 3, float(n)), (7, 1.0)], "k long, v double"), n)
        levels = [r["level"] for r in store.runs()]
        assert len(levels) == len(set(levels)) <= 1 + math.log2(n + 1)
    # a batch that comes again adds nothing
    store.add(spark.createDataFrame([(7, 100.0)], "k long, v double"), 10)
    assert rows(store.read()) == [(0, 18.0), (1, 22.0), (2, 15.0), (7, 11.0)]
    # folders that no version lists are gone
    files = store.log._files.listStatus(store.log._path(""))
    assert sum(f.getPath().getName().startswith("run-") for f in files) <= 2 * len(store.runs()) + 2


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def feed(spark, folder, batches):
    for n, data in enumerate(batches):
        spark.createDataFrame(data, EVENTS.replace("timestamp", "timestamp_ntz")).coalesce(1).write.mode("append").parquet(folder)
    return freshness.event_stream(spark, folder, files_per_batch=1)


def test_running_scores_after_many_batches_equal_one(spark, tmp_path):
    day = dt.datetime(2024, 1, 1)
    data = [(n, day + dt.timedelta(days=n % 9), n % 4, "click", 0.0, f'{{"k": {n % 5}}}') for n in range(60)]
    many = feed(spark, str(tmp_path / "many"), [data[k::11] for k in range(11)])
    one = feed(spark, str(tmp_path / "one"), [data])
    found = [freshness.running_scores([freshness.scored_events(s)], dt.date(2024, 1, 7)) for s in (many, one)]
    a, b = (rows(f, "user_id", "book_id", F.round("interaction_score", 9)) for f in found)
    assert a == b and len(a) == 20


def test_a_stale_list_is_marked_once(spark, tmp_path):
    made = dt.datetime(2024, 1, 10)
    snapshot = spark.createDataFrame(
        [(u, 1, made, made + dt.timedelta(days=2)) for u in (1, 2, 3, 4)] + [(4, 1, made + dt.timedelta(days=1), made + dt.timedelta(days=3))],
        "user_id long, book_id long, generated_at timestamp, expires_at timestamp",
    )

    def event(n, user, hours, kind="purchase"):
        return (n, made + dt.timedelta(hours=hours), user, kind, 0.0, "")

    batches = [
        [event(1, 1, 5), event(1, 1, 5), event(2, 2, -3), event(3, 3, 4, "click")],
        [event(1, 1, 5), event(4, 1, 9), event(5, 4, 20)],  # repeated; before the newer list of user 4
        [event(6, 3, 30, "view"), event(7, 1, 2)],  # late by more than a day of event time, but within the delay
        [event(8, 4, 40), event(8, 4, 40), event(9, 2, 49)],  # user 2: after the expiry
        [event(10, 5, 5), event(11, 1, 500)],  # no list; long after
        [event(12, 1, 6), event(13, 3, 31)],  # behind the watermark by now
    ]
    stream = feed(spark, str(tmp_path / "events"), batches)
    found = freshness.stale_lists(stream, snapshot, "2 days")
    later = made + dt.timedelta(days=1)
    assert rows(found) == [(1, made, 1), (3, made, 1), (4, later, 1)]


def test_marks_are_forgotten_when_the_list_has_expired(spark, tmp_path):
    made = dt.datetime(2024, 1, 10)
    snapshot = spark.createDataFrame(
        [(u, made, made + dt.timedelta(days=1)) for u in range(20)], "user_id long, generated_at timestamp, expires_at timestamp"
    )
    first = [(u, made + dt.timedelta(hours=1), u, "view", 0.0, "") for u in range(20)]
    gone = [[(100 + k, made + dt.timedelta(days=9 + k), 0, "view", 0.0, "")] for k in range(3)]
    marks = freshness.stale_marks(feed(spark, str(tmp_path / "events"), [first, *gone]), snapshot)
    progress = []
    query = marks.writeStream.option("checkpointLocation", str(tmp_path / "progress")).foreachBatch(lambda b, n: b.count())
    query = query.trigger(availableNow=True).start()
    query.awaitTermination()
    progress = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(progress) == 20 and progress[-1] == 0

"""The inbox as keyed state: what a plain loop over all weeks gives, whatever the batches; restarts and replays change nothing."""

import datetime

import pytest

from cohortmill.streaming import labelstate as L
from cohortmill.streaming.inbox import label_stream

MONDAY = datetime.datetime(2024, 1, 1)
SCHEMA = "label string, week timestamp, note string"
at = lambda k: MONDAY + k * datetime.timedelta(days=L.WEEK)
day = lambda k: at(k).date()

#: label, the weeks it is seen in, the week of a note and the note
CASES = [
    ("stays", [0, 1, 2, 3, 4], None), ("leaves", [0, 1], None), ("returns", [0, 2, 3], None), ("late comer", [4], None), ("last but one", [3], None),
    ("resolved", [0, 1, 2, 3], (1, "a unit")), ("noted first", [2, 3], (1, "known")), ("noted twice", [0, 1, 2], (1, "b")), ("gone, noted", [0], (3, "old")), ("", [1, 2], None), ("é 日", [0, 4], None),
]


def rows(weeks):
    out = []
    for label, seen, noted in CASES:
        out += [(label, at(k), None) for k in seen if k in weeks for _ in (0, 1)]  # every row twice
        if noted and noted[0] in weeks:
            out += [(label, at(noted[0]), noted[1])] + ([(label, at(noted[0]), "c")] if label == "noted twice" else [])
    return out + [(None, at(weeks[0]), None), ("no week", None, None)]


def expected():
    """The written rules, week by week over everything at once."""
    out = []
    for label, seen, noted in CASES:
        first = last = note = None
        is_open, nth = False, 0
        for k in range(5):
            events = []
            if is_open and k not in seen and last == k - 1:
                is_open = False
                events.append(("left", k))
            if k in seen and note is None and not is_open:
                is_open, first = True, k
                last = k
                events.append(("opened", k))
            if k in seen:
                first, last = (k if first is None else first), k
            if noted and noted[0] == k and note is None:
                note = noted[1]
                if is_open:
                    is_open = False
                    events.append(("resolved", k))
            for event, week in events:
                nth += 1
                out.append((label, nth, event, day(week), day(first), day(last), note))
    return sorted(out, key=repr)


@pytest.fixture
def rocks(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(name, before)


@pytest.mark.parametrize("batches", [[[0, 1, 2, 3, 4]], [[0], [1, 2], [3, 4]]])
def test_changes_are_those_of_one_batch(rocks, tmp_path, batches):
    arriving, out, marks = (str(tmp_path / n) for n in ("arriving", "changes", "marks"))

    def run():
        L.keep_changes(L.inbox_changes(label_stream(rocks, arriving, SCHEMA, 100)), out, marks).awaitTermination()
        return sorted((tuple(r) for r in rocks.read.parquet(out).select("label", "nth", "event", "week", "first_seen", "last_seen", "note").collect()), key=repr)

    for weeks in batches:
        rocks.createDataFrame(rows(weeks), SCHEMA).coalesce(1).write.mode("append").parquet(arriving)
        got = run()
    assert got == expected()
    assert run() == got  # nothing new arrives
    rocks.createDataFrame([("stays", at(0), None)], SCHEMA).coalesce(1).write.mode("append").parquet(arriving)
    assert run() == got  # far too late
    open_ = {r["label"]: (r["first_seen"], r["weeks_open"]) for r in L.standing(rocks.read.parquet(out), "2024-01-29").collect()}
    assert open_ == {"stays": (day(0), 4), "late comer": (day(4), 0), "é 日": (day(4), 0)}

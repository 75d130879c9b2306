"""A curation inbox as keyed state: each label's standing lives in the state store, and only its changes are written."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: A snapshot a week, days counted from 1970. A label's timer stands before the next snapshot is due, by a day for late rows and more for time zones.
WEEK, TIMER_HOURS = 7, 126
CHANGES = "label string, nth long, event string, week long, first_seen long, last_seen long, note string"
STANDING = "first_seen long, last_seen long, is_open boolean, note string, nth long"


class LabelInbox(StatefulProcessor):
    """Rows (label, day, note): an unrecognised label of a weekly snapshot (note null) or a curator's note on it.

    opened: in a snapshot, and not open. left: absent from the snapshot after the last it was in; seen again, it opens anew.
    resolved: a note came while it was open; it opens no more, and the first note and first_seen stay for good. A note on a label that is
    not open counts from then on, silently. Of one week, snapshots come before notes, and repeated rows count once. A snapshot that is not later than the last one
    of its label changes nothing. A timer tells the absence of labels that no row speaks of."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.standing = handle, handle.getValueState("standing", STANDING)

    def _held(self) -> list:
        return list(self.standing.get()) if self.standing.exists() else [None, None, False, None, 0]

    def _keep(self, first, last, is_open, note, nth) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if is_open:
            self.handle.registerTimer((last * 24 + TIMER_HOURS) * 3_600_000)
        self.standing.update((first, last, is_open, note, nth))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, last, is_open, note, nth = self._held()
        change = lambda event, week: Row(label=key[0], nth=nth, event=event, week=week, first_seen=first, last_seen=last, note=note)
        for week, said in sorted({(r["day"], r["note"] or "") for r in rows}):
            if is_open and week - last > (WEEK - 1 if said else WEEK):
                is_open, nth = False, nth + 1
                yield change("left", last + WEEK)
            if said:
                note = note or said
                if is_open:
                    is_open, nth = False, nth + 1
                    yield change("resolved", week)
            elif last is None or week > last:
                if note is None and not is_open:
                    first, last, is_open, nth = week, week, True, nth + 1
                    yield change("opened", week)
                first, last = week if first is None else first, week
        self._keep(first, last, is_open, note, nth)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        first, last, is_open, note, nth = self._held()
        if is_open:
            self._keep(first, last, False, note, nth + 1)
            yield Row(label=key[0], nth=nth + 1, event="left", week=last + WEEK, first_seen=first, last_seen=last, note=note)

    def close(self) -> None:
        pass


def inbox_changes(stream: DataFrame, late: str = "1 day") -> DataFrame:
    """The changes of a stream of (label, week, note), week a timestamp. Snapshots come in the order of weeks; rows later than `late` (up to a day)
    behind the newest are dropped, and rows without label or week. An empty note is none. Needs the RocksDB state store."""
    rows = stream.filter("label is not null and week is not null").select("label", "week", F.unix_date(F.to_date("week")).cast("long").alias("day"), "note").withWatermark("week", late)
    found = rows.groupBy("label").transformWithState(LabelInbox(), CHANGES, "Append", "EventTime")
    return found.withColumns({c: F.date_from_unix_date(F.col(c).cast("int")) for c in ("week", "first_seen", "last_seen")})


def keep_changes(changes: DataFrame, folder: str, checkpoint: str):
    """Appends each micro-batch's changes, exactly once: the sink's log names the files of every finished batch, so a replay adds none."""
    return changes.writeStream.outputMode("append").format("parquet").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def standing(changes: DataFrame, as_of: str) -> DataFrame:
    """The open labels by their last change, with weeks_open at a date."""
    latest = changes.groupBy("label").agg(F.max(F.struct("nth", "event", "first_seen")).alias("c")).filter("c.event = 'opened'")
    return latest.select("label", "c.first_seen", F.floor(F.datediff(F.lit(as_of).cast("date"), "c.first_seen") / 7).alias("weeks_open"))

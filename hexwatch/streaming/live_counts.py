"""R2: running cell-hour counts over a stream of incidents, with and without copies."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

HOUR_MS = 3_600_000
#: Groups that the keys are dealt to. A group is one call and one state value, read and written whole when a row of it arrives.
#: A checkpoint belongs to one number of groups.
GROUPS = 4096
#: Keys as text: nulls are written and times are whole, so that different keys have different texts.
EXACT = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
#: A group's timer, and a JSON object of its keys: position, cell, type, hour and expiry of the first row of each.
HELD = "due long, first string"
CHANGES = "h3_index string, crime_type string, at timestamp, change int"


def hourly(changes: DataFrame, time: str, amount: str, distinct: bool) -> DataFrame:
    """Sums of `amount` per (cell, hour), each emitted once the watermark has passed the hour.

    Distinct types are exact: hours are summed per type first, and the types that are left are counted when an hour closes.
    So the state of an open hour is a number per type that occurred in it.
    """
    if not distinct:
        per_hour = changes.groupBy(F.window(time, "1 hour"), "h3_index").agg(F.sum(amount).alias("crime_count"))
        return per_hour.where("crime_count > 0").select("h3_index", F.col("window.start").alias("time_window"), "crime_count")
    per_type = changes.groupBy(F.window(time, "1 hour"), "h3_index", "crime_type").agg(F.sum(amount).alias("n"))
    closed = per_type.groupBy(F.window(F.window_time("window"), "1 hour"), "h3_index").agg(
        F.sum("n").alias("crime_count"), F.count_if((F.col("n") > 0) & F.col("crime_type").isNotNull()).alias("distinct_crime_types"))
    return closed.where("crime_count > 0").select("h3_index", F.col("window.start").alias("time_window"), "crime_count", "distinct_crime_types")


def live_counts(incidents: DataFrame, lateness: str = "2 hours", distinct: bool = True) -> DataFrame:
    """Counts per (cell, hour) of everything that arrives."""
    return hourly(incidents.withWatermark("occurred_at", lateness).withColumn("one", F.lit(1)), "occurred_at", "one", distinct)


class FirstCopies(StatefulProcessor):
    """Of the rows of one key that have arrived, the one with the least position counts.

    When a row with a lesser position comes, what the former one had added is taken back, as long as the hours of both are
    open; a closed hour keeps its count, and then so does its row. Rows that the table would not hold (no cell) come
    first like others and count for nothing. A key is forgotten at the first full hour when the watermark has passed its last
    event by `keep_ms`.

    A call gets the rows of a whole group of keys and keeps their first rows in one value, since every look at the state
    is a message to the JVM: per group there are a handful, however many keys it has. One timer stands for the group's next key to forget.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.first = handle.getValueState("first", HELD)

    def read(self) -> tuple[int | None, dict[str, list]]:
        state = self.first.get()
        return (None, {}) if state is None else (state[0], json.loads(state[1]))

    def write(self, due: int | None, held: dict[str, list]) -> None:
        """Keep `held`, with the timer at the next expiry in place of `due`."""
        expires = min(row[4] for row in held.values())
        if expires != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(expires)
        self.first.update((expires, json.dumps(held, separators=(",", ":"))))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        due, held = self.read()
        arrived: dict[str, list] = {}  # first row and last event of the keys that rows arrived for
        for r in rows:
            of_key = arrived.get(r.key)
            if of_key is None:
                of_key = arrived[r.key] = [held.get(r.key), watermark]
            of_key[1] = max(of_key[1], r.at_ms or 0)
            if of_key[0] is None or r.pos < of_key[0][0]:
                of_key[0] = (r.pos, r.h3_index if r.at_ms is not None else None, r.crime_type, (r.at_ms or 0) // HOUR_MS * HOUR_MS)
        changed = []
        for k, (now, latest) in arrived.items():
            before = held.get(k)
            if before is not None and now is not before and before[1] is not None and before[3] + HOUR_MS <= watermark:
                now = before  # its hour is closed
            expires = -(-(latest + self.keep_ms) // HOUR_MS) * HOUR_MS
            held[k] = (*now[:4], max(expires, before[4] if before else 0))
            if now is not before:
                changed += [(row, change) for row, change in ((before, -1), (now, 1)) if row is not None and row[1] is not None]
        self.write(due, held)
        for row, change in changed:
            # The hour's last moment: as long as the hour is open the watermark has not passed it.
            at = dt.datetime.fromtimestamp((row[3] + HOUR_MS - 1) / 1000, dt.timezone.utc)
            yield Row(h3_index=row[1], crime_type=row[2], at=at, change=change)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(timerValues.getCurrentWatermarkInMs() - 1, expiredTimerInfo.getExpiryTimeInMs())
        _, held = self.read()
        held = {k: row for k, row in held.items() if row[4] > passed}
        if held:
            self.write(None, held)
        else:
            self.first.clear()
        yield from ()

    def close(self) -> None:
        pass


def live_first_counts(rows: DataFrame, keys: list[str], position: str, lateness: str = "2 hours", keep_hours: int = 720, distinct: bool = True) -> DataFrame:
    """Counts per (cell, hour) of the first copy of every key: those of A1 over the deduplicated table, hour by hour as they close.

    `rows` have the keys (null is a key), a position, h3_index (null if the table would not hold the row), crime_type and occurred_at.
    Hours equal A1 if all copies of a row arrive before an hour of one of them closes, and within `keep_hours` of each other.
    """
    timed = rows.withWatermark("occurred_at", lateness).select(
        F.to_json(F.struct(*keys), EXACT).alias("key"), F.col(position).cast("long").alias("pos"), "h3_index", "crime_type",
        F.unix_millis("occurred_at").alias("at_ms"), "occurred_at").withColumn("part", F.pmod(F.xxhash64("key"), F.lit(GROUPS)))
    changes = timed.groupBy("part").transformWithState(FirstCopies(keep_hours * HOUR_MS), CHANGES, "append", "eventtime", eventTimeColumnName="at")
    return hourly(changes, "at", "change", distinct)

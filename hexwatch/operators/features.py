"""Feature table per (cell, hour): dense grid (J5), look-back sums (W2-W6), calendar parts (F11-F17), targets (M2).

Events are counted per cell and hour first, so what a window partition holds is bounded by the hours of the period
and not by the events of a busy cell. Gap filling and look-backs use the same partitioning: one exchange by cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hexwatch.functions import times

HOUR_NO = "hour_no"
# Our choice: look-backs end before the current hour, missing hours count 0, the 30-day mean is over 720 hours.
LOOKBACKS = {
    "crimes_last_1h": (-1, -1),
    "crimes_last_24h": (-24, -1),
    "crimes_last_7d": (-168, -1),
    "same_hour_last_week": (-168, -168),
}
MONTH_HOURS = 720
FEATURE_COLUMNS = [
    "h3_index", "time_window", "hour_of_day", "day_of_week", "is_weekend", "is_night", "is_holiday", "month", "season",
    "crimes_last_1h", "crimes_last_24h", "crimes_last_7d", "same_hour_last_week", "rolling_avg_30d",
    "target_crime_count", "target_binary",
]


def hourly_counts(gold: DataFrame) -> DataFrame:
    return gold.groupBy("h3_index", times.hour_number(F.col("occurred_at")).alias(HOUR_NO)).agg(
        F.count(F.lit(1)).alias("crime_count")
    )


def densify(counts: DataFrame, span: str = "cell", start: Column | None = None, end: Column | None = None) -> DataFrame:
    """A row for every hour, 0 where nothing happened.

    `span` is each cell's own first to last hour (`cell`) or the period of the whole table (`table`); `start` and
    `end` (hour numbers) widen it. Every row fills the gap up to its cell's next row, so there is neither a calendar
    to join nor a cross product of cells and hours.
    """
    if span == "table":
        period = counts.agg(F.struct(F.min(HOUR_NO).alias("first"), F.max(HOUR_NO).alias("last"))).scalar()
        start = period["first"] if start is None else start
        end = period["last"] if end is None else end
    elif span != "cell":
        raise ValueError(f"span must be cell or table, is {span!r}")
    by_hour = Window.partitionBy("h3_index").orderBy(HOUR_NO)
    here, following = F.col(HOUR_NO), F.col("_next")
    rows = counts.withColumns({
        "_next": F.lead(HOUR_NO).over(by_hour),
        "_leads": F.lag(HOUR_NO).over(by_hour).isNull(),
    })
    low = here if start is None else F.when(F.col("_leads"), F.least(here, start)).otherwise(here)
    last = here if end is None else F.greatest(here, end)
    filled = rows.select(
        "h3_index", here.alias("_at"), "crime_count", F.explode(F.sequence(low, F.coalesce(following - 1, last))).alias(HOUR_NO)
    )
    count = F.when(F.col(HOUR_NO) == F.col("_at"), F.col("crime_count")).otherwise(F.lit(0).cast("bigint"))
    return filled.select("h3_index", HOUR_NO, count.alias("crime_count"))


def with_lookbacks(counts: DataFrame) -> DataFrame:
    """W2-W6 over hourly counts, dense or sparse: frames are by hour value, so both give the same sums.

    A look-back is the difference of two running totals. Frames that start at the beginning of the partition grow
    along with it; a sliding frame would be summed anew for every row, up to 720 values each time.
    """
    by_hour = Window.partitionBy("h3_index").orderBy(HOUR_NO)

    def until(hours_ago: int) -> Column:
        frame = by_hour.rangeBetween(Window.unboundedPreceding, -hours_ago)
        return F.coalesce(F.sum("crime_count").over(frame), F.lit(0))

    ends = {h for low, high in [*LOOKBACKS.values(), (-MONTH_HOURS, -1)] for h in (-high, 1 - low)}
    totals = counts.withColumns({f"_until_{h}": until(h) for h in sorted(ends)})

    def total(low: int, high: int) -> Column:
        return F.col(f"_until_{-high}") - F.col(f"_until_{1 - low}")

    mean = total(-MONTH_HOURS, -1).cast("decimal(20,0)") / F.lit(MONTH_HOURS).cast("decimal(10,0)")
    return totals.withColumns({
        **{name: total(*frame).cast("int") for name, frame in LOOKBACKS.items()},
        "rolling_avg_30d": mean.cast("decimal(10,4)"),
    }).drop(*[f"_until_{h}" for h in ends])


def with_calendar(df: DataFrame, holidays: DataFrame | None = None, ts: str = "time_window") -> DataFrame:
    t = F.col(ts)
    return times.with_holiday_flag(
        df.withColumns({
            "hour_of_day": times.hour_of_day(t),
            "day_of_week": times.day_of_week(t),
            "is_weekend": times.is_weekend(t),
            "is_night": times.is_night(t),
            "month": times.month(t),
            "season": times.season(t),
        }),
        holidays, ts,
    )


def with_targets(df: DataFrame) -> DataFrame:
    """M2."""
    return df.withColumns({
        "target_crime_count": F.col("crime_count").cast("int"),
        "target_binary": (F.col("crime_count") > 0).cast("int"),
    })


def changed_hours(before: DataFrame, now: DataFrame) -> DataFrame:
    """(h3_index, hour_no) whose count differs between two tables of hourly counts, of the files that a load replaced or added."""
    old = before.select("h3_index", HOUR_NO, (-F.col("crime_count")).alias("d"))
    new = now.select("h3_index", HOUR_NO, F.col("crime_count").alias("d"))
    return old.unionByName(new).groupBy("h3_index", HOUR_NO).agg(F.sum("d").alias("d")).where("d <> 0").select("h3_index", HOUR_NO)


def touched_ranges(changed: DataFrame, counts: DataFrame) -> DataFrame:
    """Per cell with a change: the hours `low` to `high` whose rows may differ, and `until`, the next hour with an event after.

    A change reaches the look-backs of the following 720 hours. On a dense grid it also makes or unmakes the rows up to the
    events next to it, so the range goes from the event before the first change to the one after the last.
    """
    span = changed.groupBy("h3_index").agg(F.min(HOUR_NO).alias("first"), F.max(HOUR_NO).alias("last"))
    hour = F.col(HOUR_NO)
    near = counts.join(span, "h3_index").groupBy("h3_index", "first", "last").agg(
        F.max(F.when(hour < F.col("first"), hour)).alias("before"), F.min(F.when(hour > F.col("last"), hour)).alias("after"),
        F.min(F.when(hour > F.col("last") + MONTH_HOURS, hour)).alias("later"))
    ranged = span.join(near, ["h3_index", "first", "last"], "left").select(
        "h3_index", F.coalesce("before", "first").alias("low"), F.greatest(F.coalesce("after", "last"), F.col("last") + MONTH_HOURS).alias("high"), "later")
    return ranged.select("h3_index", "low", "high", F.greatest("high", F.coalesce("later", "high")).alias("until"))


def refreshed_features(
    previous: DataFrame, changed: DataFrame, counts: DataFrame, holidays: DataFrame | None = None, span: str | None = "cell",
) -> DataFrame:
    """M1 kept up to date: the stored features with the rows that a load can have changed computed anew (one row per cell and hour).

    `counts` are all hourly counts as they are now, `changed` the hours in which they differ from when `previous` was made. Only the
    cells with changes are computed, from 720 hours before the first change on; all other rows are taken over. The ranges
    are one row per changed cell. `span` is `cell` or None; the hours of the whole table would change every cell.
    """
    if span not in ("cell", None):
        raise ValueError("only features by cell or of hours with events can be refreshed")
    ranges = touched_ranges(changed, counts)
    hour = F.col(HOUR_NO)
    needed = counts.join(ranges, "h3_index").where(hour.between(F.col("low") - MONTH_HOURS, F.col("until"))).select(*counts.columns)
    dense = needed if span is None else densify(needed, span)
    rows = with_targets(with_lookbacks(dense)).join(ranges, "h3_index").where(hour.between(F.col("low"), F.col("high"))).drop("low", "high", "until")
    fresh = with_calendar(rows.withColumn("time_window", F.timestamp_seconds(hour * F.lit(3600))), holidays).select(*FEATURE_COLUMNS)
    own_hour = times.hour_number(F.col("time_window"))
    marks = ranges.select(F.col("h3_index").alias("_cell"), "low", "high")
    kept = previous.join(marks, (F.col("h3_index") == F.col("_cell")) & own_hour.between(F.col("low"), F.col("high")), "left_anti")
    return kept.select(*FEATURE_COLUMNS).unionByName(fresh)


def build_features(
    gold: DataFrame, holidays: DataFrame | None = None, span: str | None = "cell",
    start: Column | None = None, end: Column | None = None,
) -> DataFrame:
    """M1: one row per (cell, hour); `span=None` keeps only hours with events."""
    counts = hourly_counts(gold)
    if span is not None:
        counts = densify(counts, span, start, end)
    rows = with_targets(with_lookbacks(counts)).withColumn(
        "time_window", F.timestamp_seconds(F.col(HOUR_NO) * F.lit(3600))
    )
    return with_calendar(rows, holidays).select(*FEATURE_COLUMNS)

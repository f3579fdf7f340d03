"""Joins by time: the state in force at a moment, and how many intervals cover a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.running import running_sums
from tidemark.sources.staging import staged

#: Rows of one key from which on its history is cut into segments, and the most segments of a key.
SEGMENT_ROWS = 1_000_000
SEGMENTS = 1000


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    tie_break: str,
    columns: list[str],
    segment_rows: int = SEGMENT_ROWS,
) -> DataFrame:
    """Each row of ``left`` with the ``columns`` of the newest row of ``right`` that has its key and is not later.

    Of rows of ``right`` at one time the one with the greatest ``tie_break`` counts. A missing key or time finds nothing,
    and a row of ``right`` without one is never found. Both sides are sorted together by key and time, and the last
    state runs along. A key with more than ``segment_rows`` rows is cut into segments of time, so that a key with a large
    part of all rows lies in many tasks; the state that a segment starts with is carried over from those before.
    """
    states = right.filter(F.col(key).isNotNull() & F.col(right_time).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(right_time).alias("_time"),
        F.lit(0).alias("_side"),
        F.col(tie_break).alias("_tie"),
        F.struct(*columns).alias("_state"),
        F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"),
    )
    rows = left.select(
        F.col(key).alias("_key"),
        F.col(left_time).alias("_time"),
        F.lit(1).alias("_side"),
        F.lit(None).cast(right.schema[tie_break].dataType).alias("_tie"),
        F.lit(None).cast(states.schema["_state"].dataType).alias("_state"),
        F.struct("*").alias("_row"),
    )
    bounds = _segment_bounds(states.select("_key", "_time").unionAll(rows.select("_key", "_time")), segment_rows)
    both = states.unionByName(rows)
    both = _with_segments(both, bounds) if bounds is not None else both.withColumn("_segment", F.lit(0))
    # Rows that can find nothing are spread over tasks of their own, however many have no key.
    known = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    apart = (-1 - F.pmod(F.xxhash64("_row"), F.lit(SEGMENTS))).cast("int")
    both = both.withColumn("_segment", F.when(known, F.col("_segment")).otherwise(apart))
    along = (
        Window.partitionBy("_key", "_segment")
        .orderBy("_time", "_side", "_tie")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = both.withColumn("_found", F.last("_state", ignorenulls=True).over(along)).filter("_side = 1")
    if bounds is not None:
        found = found.join(_carried(states.join(bounds, "_key")), ["_key", "_segment"], "left")
        found = found.withColumn("_found", F.coalesce("_found", "_carried"))
    state = F.when(known, F.col("_found"))
    return found.select("_row.*", *[state[c].alias(c) for c in columns])


def _segment_bounds(events: DataFrame, segment_rows: int) -> DataFrame | None:
    """Times that cut the histories of large keys, or None if there is no large key."""
    large = staged(
        events.filter("_key IS NOT NULL").groupBy("_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > segment_rows),
        "large-keys",
    )
    if large.isEmpty():
        return None
    shares = F.array(*[F.lit(i / SEGMENTS) for i in range(1, SEGMENTS)])
    # One row for each key with more than segment_rows rows: never more than rows / segment_rows.
    marks = events.join(large, "_key").groupBy("_key").agg(
        F.first("n").alias("n"), F.percentile_approx("_time", shares, 10 * SEGMENTS).alias("q")
    )
    pieces = F.least(F.ceil(F.col("n") / segment_rows), F.lit(SEGMENTS)).cast("int")
    at = F.transform(F.sequence(F.lit(1), pieces - 1), lambda i: F.get("q", (i * SEGMENTS / pieces).cast("int") - 1))
    return staged(marks.select("_key", F.array_distinct(at).alias("_bounds")), "segment-bounds")


def _segment_of(bounds: Column, time: str) -> Column:
    return F.size(F.filter(bounds, lambda b: b <= F.col(time)))


def _with_segments(events: DataFrame, bounds: DataFrame) -> DataFrame:
    segment = F.when(F.col("_bounds").isNull() | F.col("_time").isNull(), 0).otherwise(_segment_of(F.col("_bounds"), "_time"))
    return events.join(bounds, "_key", "left").withColumn("_segment", segment).drop("_bounds")


def _carried(states: DataFrame) -> DataFrame:
    """For each segment of a large key that has states before it: the last of them.

    ``states`` has the bounds of large keys; a segment without states of its own hands on what it was given.
    """
    last = (
        states.withColumn("_segment", _segment_of(F.col("_bounds"), "_time"))
        .groupBy("_key", "_segment")
        .agg(
            F.max_by("_state", F.struct("_time", "_tie")).alias("_carried"),
            F.max(F.size("_bounds")).alias("last"),
        )
    )
    after = Window.partitionBy("_key").orderBy("_segment")  # at most SEGMENTS rows for a key
    until = F.coalesce(F.lead("_segment").over(after), F.col("last"))
    spans = last.withColumn("until", until).filter("until > _segment")
    into = F.sequence(F.col("_segment") + 1, F.col("until"))
    return spans.select("_key", "_carried", F.explode(into).alias("_segment"))


def active_by_day(df: DataFrame, start: str, end: str, amount: str, partitions: int | None = None) -> DataFrame:
    """Intervals that cover each day, and the sum of their amounts, from the first start to the last change.

    An interval covers its start and the days up to its end, without the end; one without an end goes on, one without a
    start, or that does not end after its start, covers nothing; a missing amount adds nothing. Every interval is two
    events, the events of a day fold into one row, and running sums of those give the answer: there is never a row for
    each day of each interval. Amounts are summed as decimals, so that what ends takes away exactly what started.
    """
    spans = df.select(
        F.col(start).cast("date").alias("start"),
        F.col(end).cast("date").alias("end"),
        F.coalesce(F.col(amount).cast("decimal(28,4)"), F.lit(0).cast("decimal(28,4)")).alias("amount"),
    ).filter("start IS NOT NULL AND (end IS NULL OR end > start)")
    event = lambda day, sign: F.struct(F.col(day).alias("Day"), F.lit(sign).alias("n"), (F.col("amount") * sign).alias("x"))
    events = spans.select(F.explode(F.array(event("start", 1), event("end", -1))).alias("e")).filter("e.Day IS NOT NULL")
    days = events.groupBy("e.Day").agg(F.sum("e.n").alias("n"), F.sum("e.x").cast("decimal(38,4)").alias("x"))
    changes = running_sums(days, [], ["Day"], {"Active": "n", "Amount": "x"}, partitions)
    return _every_day(staged(changes.select("Day", "Active", "Amount"), "changes"))


def _every_day(changes: DataFrame) -> DataFrame:
    """Days between changes have the values of the change before them.

    Rows meet in the year that they lie in; the first change of the next year that has one is handed to them.
    """
    year = F.year("Day")
    by_year = Window.orderBy("_year")  # one row for each year
    firsts = changes.groupBy(year.alias("_year")).agg(F.min("Day").alias("_first"))
    firsts = staged(firsts.select("_year", F.lead("_first").over(by_year).alias("_later")), "years")
    inside = F.lead("Day").over(Window.partitionBy("_year").orderBy("Day"))
    rows = changes.withColumn("_year", year).withColumn("_inside", inside).join(firsts, "_year")
    following = F.coalesce("_inside", "_later")
    days = F.explode(F.sequence("Day", F.coalesce(F.date_sub(following, 1), F.col("Day"))))
    return rows.select(days.alias("Day"), F.col("Active").cast("long"), F.col("Amount").cast("double"))

"""Predicates and joins on dates and intervals. Intervals are half-open; a null start or end is unbounded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import CLUSTER_TOLERANCE_DAYS, SECTOR_LOOKBACK_DAYS


def active(entry: Column, exit_: Column, on: Column, supported: Column | None = None) -> Column:
    """entry <= on < exit."""
    held = (entry.isNull() | (entry <= on)) & (exit_.isNull() | (exit_ > on))
    return held if supported is None else held & supported


def valid(start: Column, end: Column, on: Column) -> Column:
    """start <= on <= end: validity is closed at both ends."""
    return (start.isNull() | (start <= on)) & (end.isNull() | (end >= on))


def changes_in_range(events: DataFrame, start: str, end: str, actions: list[str] | None = None, min_confidence: float = 0.0) -> DataFrame:
    out = events.where(F.col("effective_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))) & (F.col("confidence") >= min_confidence))
    return out.where(F.col("action").isin(actions)) if actions else out


def stab(dates: DataFrame, intervals: DataFrame, entry: str = "entry_date", exit_: str = "exit_date", on: str = "on_date", bucket_days: int = 366) -> DataFrame:
    """Each date with the intervals active then.

    Intervals are cut at multiples of bucket_days within the range of dates and joined on the bucket, so the join is an
    equi-join of any size; the interval's own bounds decide at the ends.
    """
    bucket = lambda c: F.floor(F.unix_date(c) / bucket_days)
    bounds = dates.agg(F.min(on).alias("_lo"), F.max(on).alias("_hi"))
    first, last = F.greatest(F.coalesce(F.col(entry), F.col("_lo")), F.col("_lo")), F.least(F.coalesce(F.col(exit_), F.col("_hi")), F.col("_hi"))
    cut = intervals.crossJoin(F.broadcast(bounds)).where(first <= last).withColumn("_bucket", F.explode(F.sequence(bucket(first), bucket(last)))).drop("_lo", "_hi")
    return dates.withColumn("_bucket", bucket(F.col(on))).join(cut, "_bucket").where(active(F.col(entry), F.col(exit_), F.col(on))).drop("_bucket")


def member_counts(dates: DataFrame, intervals: DataFrame, entry: str = "entry_date", exit_: str = "exit_date", on: str = "on_date") -> DataFrame:
    """(on_date, members): a sweep over the days on which anything changes, summed up per day before the window."""
    begin = intervals.where(F.col(exit_).isNull() | F.col(entry).isNull() | (F.col(exit_) > F.col(entry)))
    steps = begin.select(F.coalesce(F.col(entry), F.to_date(F.lit("0001-01-01"))).alias("day"), F.lit(1).alias("step"))
    steps = steps.union(begin.where(F.col(exit_).isNotNull()).select(F.col(exit_), F.lit(-1)))
    daily = steps.groupBy("day").agg(F.sum("step").alias("step"), F.lit(False).alias("asked"))
    daily = daily.union(dates.select(on).distinct().select(F.col(on), F.lit(0).cast("long"), F.lit(True)))
    # what changes on a day counts on that day: it stands before the question
    running = Window.orderBy("day", "asked").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("members", F.sum("step").over(running)).where("asked").select(F.col("day").alias(on), "members")


def labels_as_of(spans: DataFrame, on: Column, key: str = "company_id", label: str = "ticker") -> DataFrame:
    """(key, labels): the labels valid on a date, sorted."""
    return spans.where(valid(F.col("valid_from"), F.col("valid_to"), on)).groupBy(key).agg(F.array_sort(F.collect_set(label)).alias("tickers"))


def nearest_as_of(observations: DataFrame, on: Column, key: str, at: str, values: list[str], within: int = SECTOR_LOOKBACK_DAYS, tie: str | None = None) -> DataFrame:
    """Per key the latest observation up to the date, else the earliest after it, within so many days either way.

    An aggregation, not a window: one row per key leaves each task.
    """
    gap = F.datediff(on, F.col(at))
    near = observations.where(F.abs(gap) <= within)
    rank = F.struct((gap < 0).alias("after"), F.abs(gap).alias("gap"), *([F.col(tie)] if tie else []))
    best = near.groupBy(key).agg(F.min_by(F.struct(F.col(at), *values), rank).alias("_x"))
    return best.select(key, *[F.col(f"_x.{c}") for c in (at, *values)])


def snapshot_as_of(snapshots: DataFrame, on: Column, at: str, values: list[str]) -> DataFrame:
    """The values of the last snapshot up to the date; no row if there is none."""
    last = snapshots.where(F.col(at) <= on).agg(F.max_by(F.struct(F.col(at), *values), F.col(at)).alias("_x"))
    return last.where(F.col("_x").isNotNull()).select(*[F.col(f"_x.{c}") for c in (at, *values)])


def band_join(left: DataFrame, right: DataFrame, on: list[str], left_at: str, right_at: str, days: int, how: str = "inner") -> DataFrame:
    """Rows whose dates lie at most so many days apart, equal in the columns `on`.

    Each right row stands in for the 2 * days + 1 days around it, so this is an equi-join.
    """
    near = right.withColumn("_day", F.explode(F.sequence(F.date_sub(F.col(right_at), days), F.date_add(F.col(right_at), days))))
    if how != "inner":
        near = near.select(*on, "_day").distinct()
    return left.withColumn("_day", F.col(left_at)).join(near, [*on, "_day"], how).drop("_day")


def overlap_flag(intervals: DataFrame, others: DataFrame, key: str, days: int = CLUSTER_TOLERANCE_DAYS, name: str = "supported") -> DataFrame:
    """Whether an interval (entry_date, exit_date) meets any of its key's others (start, end), both closed and so much wider.

    The others are merged first, so that few of them meet each interval.
    """
    merged = union_intervals(others, [key], "start", "end", None, 0).select(F.col(key).alias("_key"), "start", "end")
    numbered = intervals.withColumn("_row", F.monotonically_increasing_id())
    low, high = F.date_sub("entry_date", days), F.date_add("exit_date", days)
    meets = (F.col("exit_date").isNull() | (F.col("start") <= high)) & (F.col("end").isNull() | F.col("entry_date").isNull() | (F.col("end") >= low))
    joined = numbered.join(merged, (F.col(key) == F.col("_key")) & meets, "left")
    return joined.groupBy("_row", *intervals.columns).agg(F.max(F.col("_key").isNotNull()).alias(name)).drop("_row")


def snapshots_to_intervals(observed: DataFrame, label: str, at: str, keys: list[str] | None = None) -> DataFrame:
    """(label, start, end) from (label, at) pairs of dated full lists: runs of consecutive snapshots that hold the label.

    end is the first snapshot without it, null if the last snapshot has it.
    """
    pairs = observed.select(F.col(label), F.col(at)).distinct()
    dates = pairs.select(at).distinct()
    numbered = dates.select(F.col(at).alias("_at"), F.row_number().over(Window.orderBy(at)).alias("_n"), F.lead(at).over(Window.orderBy(at)).alias("_next"))
    # rows are a few bytes when shuffled but many when sorted, so tasks aren't put together by their size on disk
    tasks = int(observed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pairs.join(F.broadcast(numbered), F.col(at) == F.col("_at")).drop("_at").repartition(tasks, label)  # a row a list
    island = F.col("_n") - F.row_number().over(Window.partitionBy(label).orderBy("_n"))
    return placed.withColumn("_island", island).groupBy(label, "_island").agg(F.min(at).alias("start"), F.max_by("_next", "_n").alias("end")).drop("_island")


def union_intervals(intervals: DataFrame, keys: list[str], start: str, end: str, label: str | None = None, days: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """Intervals of a key that overlap or lie at most so many days apart, merged; a null end takes in all later ones.

    With a label: start_label is the first one's; end_label that of the last open one, else of the earliest that reaches
    the end.
    """
    far = F.to_date(F.lit("9999-12-31"))
    ends = F.coalesce(F.col(end), far)
    order = [F.col(start), ends.asc(), *([F.col(label)] if label else [])]
    w = Window.partitionBy(*keys).orderBy(*order)
    before = F.max(ends).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(before.isNull() | ((before < far) & (F.datediff(F.col(start), before) > days)), 1).otherwise(0)
    grouped = intervals.withColumn("_fresh", fresh).withColumn("_group", F.sum("_fresh").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    aggs = [F.min(start).alias("start"), F.max(ends).alias("_end")]
    if label:
        grouped = grouped.withColumn("_pos", F.row_number().over(w))
        aggs += [F.min_by(label, "_pos").alias("start_label"), F.max_by(label, F.when(F.col(end).isNull(), F.col("_pos"))).alias("_open"), F.max_by(label, F.struct(ends, -F.col("_pos"))).alias("_far")]
    out = grouped.groupBy(*keys, "_group").agg(*aggs).withColumn("end", F.nullif("_end", far))
    names = [*keys, "start", "end"]
    if label:
        out = out.withColumn("end_label", F.coalesce("_open", "_far"))
        names += ["start_label", "end_label"]
    return out.select(*names)

"""Point-in-time analytics over intervals and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import REMOVE, UNKNOWN_ENTRY
from ..functions.dates import years
from .temporal import member_counts

UNSEEN = "Unknown / not observed"


def year_counts(events: DataFrame, at: str = "effective_date") -> DataFrame:
    """(year, additions, removals), of all events."""
    return events.where(F.col("action").isin("ADD", "REMOVE")).groupBy(F.year(at).alias("year")).agg(F.count_if(F.col("action") == "ADD").alias("additions"), F.count_if(F.col("action") == "REMOVE").alias("removals"))


def turnover(events: DataFrame, intervals: DataFrame, start_year: int, as_of: str, end_year: int | None = None) -> DataFrame:
    """Per year, none left out: additions, removals, members at its end (at as_of in a running year), turnover in percent."""
    spark = events.sparkSession
    today = F.to_date(F.lit(as_of))
    last = end_year if end_year is not None else int(as_of[:4])
    calendar = spark.range(start_year, last + 1).select(F.col("id").cast("int").alias("year"))
    calendar = calendar.withColumn("on_date", F.when(F.col("year") < F.year(today), F.make_date("year", F.lit(12), F.lit(31))).otherwise(today))
    counted = calendar.join(member_counts(calendar, intervals), "on_date", "left").join(year_counts(events), "year", "left")
    n, removals = F.coalesce("members", F.lit(0)), F.coalesce("removals", F.lit(0))
    pct = F.when(n > 0, F.round(100.0 * removals / n, 2))
    return counted.select("year", F.coalesce("additions", F.lit(0)).alias("additions"), removals.alias("removals"), n.alias("members_at_year_end"), pct.alias("turnover_pct"))


def pivot_by_year(events: DataFrame, category: str, values: list[str], start_year: int, at: str = "effective_date") -> DataFrame:
    """Removals per year and category; the vocabulary is given, so the pivot is one pass."""
    rows = events.where((F.col("action") == REMOVE) & (F.year(at) >= start_year))
    return rows.groupBy(F.year(at).alias("year")).pivot(category, values).count()


def composition(members: DataFrame, category: str, unseen: str = UNSEEN) -> DataFrame:
    """(category, count, pct); the window runs over the categories."""
    counts = members.groupBy(F.coalesce(category, F.lit(unseen)).alias(category)).agg(F.count("*").alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.withColumn("pct", F.round(100.0 * F.col("count") / total, 2))


def _days(as_of: str) -> Column:
    return F.datediff(F.coalesce("exit_date", F.to_date(F.lit(as_of))), F.coalesce("entry_date", F.to_date(F.lit(UNKNOWN_ENTRY))))


def longest(intervals: DataFrame, names: DataFrame, as_of: str, limit: int = 25, current_only: bool = False, key: str = "company_id") -> DataFrame:
    """The longest memberships; ties by key and entry."""
    rows = intervals.where("supported").join(names, key)
    if current_only:
        rows = rows.where(F.col("exit_date").isNull())
    rows = rows.withColumn("days", _days(as_of))
    out = rows.orderBy(F.col("days").desc(), key, F.col("entry_date").asc_nulls_first()).limit(limit)
    return out.select(key, "company_name", "entry_date", "exit_date", (F.col("left_censored") | F.col("entry_date").isNull()).alias("left_censored"), "days", F.round(years(F.col("days")), 2).alias("years"))


def exited(intervals: DataFrame, names: DataFrame, events: DataFrame, start: str, end: str, category: str | None = None, key: str = "company_id") -> DataFrame:
    rows = intervals.where("supported").where(F.col("exit_date").between(F.to_date(F.lit(start)), F.to_date(F.lit(end))))
    if category:
        rows = rows.where(F.col("exit_reason_category") == category)
    why = events.select(F.col("event_id").alias("exit_event_id"), "reason", "confidence", F.col("source_type").alias("exit_source"))
    days = F.datediff("exit_date", F.coalesce("entry_date", F.to_date(F.lit(UNKNOWN_ENTRY))))
    return rows.join(names, key).join(why, "exit_event_id", "left").select(key, "company_name", "exit_ticker", "entry_date", "exit_date", "exit_reason_category", "reason", "exit_source", "confidence", days.alias("days_in_index"))


def duration_stats(intervals: DataFrame, as_of: str) -> DataFrame:
    """One row: counts, upper median and mean of the completed spells in years.

    The median is the (n div 2)-th of the sorted lengths: found by counting the distinct lengths in days, not by
    gathering all spells.
    """
    whole = ~F.col("left_censored") & F.col("entry_date").isNotNull()
    done = whole & F.col("exit_date").isNotNull()
    kept = intervals.where("supported")
    counts = kept.agg(F.count("*").alias("n_intervals"), F.count_if(done).alias("n_completed"), F.count_if(whole & F.col("exit_date").isNull()).alias("n_ongoing"), F.count_if(F.col("left_censored") | F.col("entry_date").isNull()).alias("n_left_censored"), F.round(F.avg(F.when(done, years(F.datediff("exit_date", "entry_date")))), 2).alias("mean_completed_years"))
    lengths = kept.where(done).groupBy(F.datediff("exit_date", "entry_date").alias("days")).agg(F.count("*").alias("n"))
    w = Window.orderBy("days").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lengths.withColumn("upto", F.sum("n").over(w)).withColumn("total", F.sum("n").over(Window.partitionBy()))
    median = placed.where(F.col("upto") > F.expr("total div 2")).agg(F.round(years(F.min("days")), 2).alias("median_completed_years"))
    return counts.crossJoin(F.broadcast(median))  # a row each


def duration_histogram(intervals: DataFrame, width: int = 5, unit: Column | None = None) -> DataFrame:
    """(bin, label, count) of the completed spells, bins of `width` years (or of another unit, a Column of the days)."""
    done = intervals.where("supported").where(~F.col("left_censored") & F.col("entry_date").isNotNull() & F.col("exit_date").isNotNull())
    length = years(F.datediff("exit_date", "entry_date")) if unit is None else unit
    low = (F.floor(length / width) * width).cast("long")
    return done.groupBy(low.alias("bin")).agg(F.count("*").alias("count")).select("bin", F.concat(F.col("bin").cast("string"), F.lit("-"), (F.col("bin") + width).cast("string"), F.lit("y")).alias("label"), "count")


def survival(intervals: DataFrame, cohort_start: str, cohort_end: str, as_of: str, horizon_years: float = 25) -> DataFrame:
    """Kaplan–Meier estimate of those that entered from cohort_start to cohort_end: (years, survival, at_risk).

    Spells are summed per length in days before the windows, whose rows are the distinct lengths; the product is a fold
    in order, exact at factors of zero.
    """
    cohort = intervals.where("supported").where(F.col("entry_date").between(F.to_date(F.lit(cohort_start)), F.to_date(F.lit(cohort_end))))
    t = F.datediff(F.coalesce("exit_date", F.to_date(F.lit(as_of))), "entry_date")
    per = cohort.groupBy(t.alias("days")).agg(F.count("*").alias("c"), F.count("exit_date").alias("d"))
    down = Window.orderBy(F.col("days").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    risk = per.withColumn("at_risk", F.sum("c").over(down))
    factors = F.transform(F.array_sort(F.collect_list(F.when(F.col("d") > 0, F.struct("days", (1 - F.col("d").cast("double") / F.col("at_risk")).alias("f"), "at_risk")))), lambda x: x)
    empty = F.struct(F.lit(1.0).alias("s"), F.array().cast("array<struct<days:int,survival:double,at_risk:bigint>>").alias("rows"))

    def step(acc: Column, x: Column) -> Column:
        s = acc["s"] * x["f"]
        return F.struct(s.alias("s"), F.concat(acc["rows"], F.array(F.struct(x["days"].alias("days"), s.alias("survival"), x["at_risk"].alias("at_risk")))).alias("rows"))

    curve = risk.agg(F.aggregate(factors, empty, step)["rows"].alias("rows"), F.max("at_risk").alias("n"))
    start = F.struct(F.lit(0).alias("days"), F.lit(1.0).alias("survival"), F.coalesce("n", F.lit(0).cast("long")).alias("at_risk"))
    rows = curve.select(F.explode(F.concat(F.array(start), F.col("rows"))).alias("x"))
    out = rows.select(F.round(years(F.col("x.days")), 3).alias("years"), F.round("x.survival", 4).alias("survival"), F.col("x.at_risk").alias("at_risk"))
    return out.where(F.col("years") <= horizon_years)


def cemetery(intervals: DataFrame, names: DataFrame, limit: int = 2000, key: str = "company_id") -> DataFrame:
    """Keys whose latest spell has ended, the latest first; ties by key. An unknown entry counts as the earliest."""
    entry = F.coalesce("entry_date", F.to_date(F.lit("0001-01-01")))
    last = intervals.where("supported").groupBy(key).agg(F.max_by(F.struct("exit_ticker", "entry_date", "exit_date", "exit_reason_category", "left_censored"), F.struct(entry.alias("e"), (-F.unix_date(F.coalesce("exit_date", F.to_date(F.lit("9999-12-31"))))).alias("x"))).alias("i"))
    rows = last.select(key, "i.*").where(F.col("exit_date").isNotNull()).join(names, key)
    length = F.round(years(F.datediff("exit_date", F.coalesce("entry_date", F.to_date(F.lit(UNKNOWN_ENTRY))))), 2)
    return rows.orderBy(F.col("exit_date").desc(), key).limit(limit).select(key, "company_name", "exit_ticker", "entry_date", "exit_date", "exit_reason_category", length.alias("years_in_index"), "left_censored")


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("kind").agg(F.count("*").alias("n"))


def discrepancy_counts(ranges: DataFrame) -> DataFrame:
    return ranges.groupBy("comparison", "severity", "kind").agg(F.count("*").alias("n"))


def latest_by(rows: DataFrame, keys: list[str], at: str, line: str | None = None) -> DataFrame:
    """Per key the row with the greatest `at`, the first line of equal ones."""
    order = F.struct(F.col(at), *([-F.col(line)] if line else []))
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), order).alias("_x")).select(*keys, "_x.*")

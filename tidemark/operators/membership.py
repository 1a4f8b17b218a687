"""Claims to events to intervals: anchored clusters, corroboration, and the membership state machine as windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import ADD, CHANGES, CLUSTER_TOLERANCE_DAYS, CONFIDENCE_CAP, CORROBORATION_BUMP, DATE_ADDED, REFERENCE, REMOVE, TICKER_CHANGE
from ..functions.text import OTHER_REASON

#: Order of the actions of one day: a day's addition stands before its removal.
ACTION_ORDER = {ADD: 0, TICKER_CHANGE: 1, REMOVE: 2}


def action_order(action: Column) -> Column:
    return F.when(action == ADD, 0).when(action == TICKER_CHANGE, 1).otherwise(2)


def anchored_clusters(claims: DataFrame, keys: list[str], at: str, days: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """claims with `anchor`, the first date of their cluster: a claim within so many days of the anchor belongs to it.

    A gap of more than that from the claim before always starts a cluster, so a key's dates fall apart into sessions
    first; within one the distinct days are folded in order, which is never long, whatever the number of claims.
    """
    dates = claims.groupBy(*keys, at).agg(F.count("*").alias("_claims"))
    w = Window.partitionBy(*keys).orderBy(at)
    gap = F.datediff(F.col(at), F.lag(at).over(w))
    sessions = dates.withColumn("_new", F.when(gap.isNull() | (gap > days), 1).otherwise(0)).withColumn("_session", F.sum("_new").over(w))
    folded = sessions.groupBy(*keys, "_session").agg(F.array_sort(F.collect_list(at)).alias("_dates"))
    none = F.struct(F.lit(None).cast("date").alias("anchor"), F.array().cast("array<date>").alias("all"))

    def step(acc: Column, d: Column) -> Column:
        fresh = acc["anchor"].isNull() | (F.datediff(d, acc["anchor"]) > days)
        return F.when(fresh, F.struct(d.alias("anchor"), F.concat(acc["all"], F.array(d)).alias("all"))).otherwise(acc)

    anchors = folded.withColumn("_anchors", F.aggregate("_dates", none, step)["all"])
    each = anchors.select(*keys, "_anchors", F.explode("_dates").alias(at))
    each = each.select(*keys, at, F.array_max(F.filter("_anchors", lambda a: a <= F.col(at))).alias("anchor"))
    return claims.join(each, [*keys, at])


def corroborated(clustered: DataFrame, keys: list[str], at: str = "effective_date", tie: str = "claim_id") -> DataFrame:
    """One event per cluster: the surest claim, its confidence raised for each other source type.

    Ties go to claims that aren't the reference's, then to those with a name, then to the earliest (by date and tie).
    """
    first = F.struct(F.datediff(F.to_date(F.lit("9999-12-31")), F.col(at)), -F.col(tie))
    best = F.struct(F.col("confidence"), (F.col("source_type") != REFERENCE).alias("a"), (F.coalesce(F.col("name"), F.lit("")) != "").alias("b"), first.alias("c"))
    order = F.struct(F.col(at), -F.col("confidence"), F.col(tie))
    named, reasoned = F.when(F.coalesce("name", F.lit("")) != "", F.col("name")), F.when(F.coalesce("reason", F.lit("")) != "", F.col("reason"))
    category = F.when(F.col("reason_category") != OTHER_REASON, F.col("reason_category"))
    picked = F.struct(at, "label", "name", "reason", "reason_category", "source_type", "confidence", F.col(tie).alias("tie"))
    by = clustered.groupBy(*keys, "anchor").agg(
        F.max_by(picked, best).alias("p"), F.array_sort(F.collect_set("source_type")).alias("sources"), F.count("*").alias("n_claims"),
        F.min_by(named, F.when(named.isNotNull(), order)).alias("any_name"), F.min_by(reasoned, F.when(reasoned.isNotNull(), order)).alias("any_reason"),
        F.min_by(category, F.when(category.isNotNull(), order)).alias("any_category"),
    )
    others = F.array_except("sources", F.array("p.source_type"))
    return by.select(
        *keys, F.col(f"p.{at}").alias(at), F.col("p.label").alias("label"), F.coalesce(F.nullif("p.name", F.lit("")), "any_name").alias("name"),
        F.coalesce(F.nullif("p.reason", F.lit("")), "any_reason").alias("reason"),
        F.when(F.col("p.reason_category") != OTHER_REASON, F.col("p.reason_category")).otherwise(F.coalesce("any_category", F.lit(OTHER_REASON))).alias("reason_category"),
        F.col("p.source_type").alias("source_type"), F.round(F.least(F.lit(CONFIDENCE_CAP), F.col("p.confidence") + CORROBORATION_BUMP * F.size(others)), 3).alias("confidence"),
        others.alias("corroborating_sources"), "n_claims", F.col("p.tie").alias("claim_id"),
    )


def _placed(events: DataFrame, key: str, at: str, tie: str) -> DataFrame:
    """ADDs and REMOVEs with the spell that each belongs to: the number of removals before it."""
    w = Window.partitionBy(key).orderBy(at, action_order(F.col("action")), tie)
    spell = F.coalesce(F.sum(F.when(F.col("action") == REMOVE, 1).otherwise(0)).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(w)
    return events.where(F.col("action").isin(ADD, REMOVE)).withColumn("_spell", spell).withColumn("_nth", nth)


def _openers(placed: DataFrame, key: str, at: str, earliest_reference: DataFrame | None, days: int) -> DataFrame:
    """placed with, per spell, its opening ADD and the ADD that supersedes it (both as structs, null if none).

    An opening that comes from a 'date added' column gives way to the first later ADD of the changes table, unless the
    reference shows membership before that.
    """
    w = Window.partitionBy(key, "_spell")
    adds = F.when(F.col("action") == ADD, F.struct("_nth", F.col(at).alias("at"), "event_id", "label", "source_type", "left_censored"))
    out = placed.withColumn("_open", F.min(adds).over(w))
    if earliest_reference is not None:
        out = out.join(earliest_reference, key, "left")
    else:
        out = out.withColumn("earliest_reference", F.lit(None).cast("date"))
    late = F.col("earliest_reference").isNull() | (F.col("earliest_reference") >= F.date_sub(F.col(at).cast("date"), days))
    over = (F.col("_open.source_type") == DATE_ADDED) & (F.col("action") == ADD) & (F.col("source_type") == CHANGES) & (F.col("_nth") > F.col("_open._nth")) & late
    return out.withColumn("_over", F.min(F.when(over, adds)).over(w))


def derive_intervals(events: DataFrame, key: str = "company_id", at: str = "effective_date", tie: str = "event_id", earliest_reference: DataFrame | None = None, days: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """Membership intervals of events (key, at, action, event_id, label, source_type, left_censored, reason_category).

    Within a key, a spell runs from the removal before to the next one. Its first ADD opens the interval; a spell
    without ADD is left-censored and begins where the spell before it ended, if there is one.
    """
    placed = _openers(_placed(events, key, at, tie), key, at, earliest_reference, days)
    removed = F.when(F.col("action") == REMOVE, F.struct(F.col(at).alias("at"), "event_id", "label", "reason_category"))
    spells = placed.groupBy(key, "_spell").agg(F.max("_open").alias("o"), F.max("_over").alias("s"), F.max(removed).alias("r"))
    previous = F.lag("r.at").over(Window.partitionBy(key).orderBy("_spell"))
    opened = F.coalesce("s", "o")
    spells = spells.withColumn("e", opened).withColumn("_before", previous)
    return spells.select(
        key, F.coalesce("e.at", F.when(F.col("e").isNull(), F.col("_before"))).alias("entry_date"), F.col("r.at").alias("exit_date"), F.col("e.event_id").alias("entry_event_id"), F.col("r.event_id").alias("exit_event_id"),
        F.coalesce("e.label", "r.label").alias("entry_ticker"), F.coalesce("r.label", "e.label").alias("exit_ticker"), F.coalesce("r.reason_category", F.lit("")).alias("exit_reason_category"),
        (F.col("e").isNull() | F.coalesce("o.left_censored", F.lit(False))).alias("left_censored"),
    )


def kept_events(events: DataFrame, key: str = "company_id", at: str = "effective_date", tie: str = "event_id", earliest_reference: DataFrame | None = None, days: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """The events that make up the intervals: all but the ADDs that derive_intervals() passes over or supersedes."""
    placed = _openers(_placed(events, key, at, tie), key, at, earliest_reference, days)
    opens = (F.col("action") == REMOVE) | (F.col("_nth") == F.coalesce("_over._nth", "_open._nth"))
    return placed.where(opens).select(events.columns).union(events.where(~F.col("action").isin(ADD, REMOVE)))


def interval_issues(events: DataFrame, key: str = "company_id", at: str = "effective_date", tie: str = "event_id", earliest_reference: DataFrame | None = None, days: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """(key, kind, on_date) of every anomaly that derive_intervals() decides about."""
    placed = _openers(_placed(events, key, at, tie), key, at, earliest_reference, days)
    later = placed.where((F.col("action") == ADD) & (F.col("_nth") > F.col("_open._nth")))
    kind = (
        F.when(F.col("_nth") == F.col("_over._nth"), "entry_date_superseded")
        .when(F.col("_open.left_censored"), "entry_after_opening")
        .when(F.col("source_type") == REFERENCE, "duplicate_add")
        .otherwise("conflicting_entry_date")
    )
    doubled = later.select(key, kind.alias("kind"), F.col(at).alias("on_date"))
    removals = placed.where(F.col("action") == REMOVE)
    orphans = removals.where(F.col("_open").isNull()).select(key, F.lit("remove_without_add").alias("kind"), F.col(at).alias("on_date"))
    entered = F.coalesce("_over.at", "_open.at", F.lag(at).over(Window.partitionBy(key).orderBy("_spell")))
    empty = removals.withColumn("_entered", entered).where(F.col("_entered") == F.col(at)).select(key, F.lit("same_day_add_remove").alias("kind"), F.col(at).alias("on_date"))
    return doubled.union(orphans).union(empty)

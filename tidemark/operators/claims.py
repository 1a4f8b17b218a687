"""Claims from the sources: one candidate row per claim that something joined or left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ADD, CHANGES, CURATED, DATE_ADDED, REFERENCE, REMOVE, SOURCE_CONFIDENCE, TICKER_CHANGE
from ..functions.text import OTHER_REASON, classify_reason
from .temporal import snapshots_to_intervals, union_intervals

COLUMNS = ("effective_date", "action", "ticker", "name", "source_type", "confidence", "reason", "reason_category", "counterpart_ticker", "notes", "refs")


def _refs():
    return F.array().cast("array<string>")


def from_changes(rows: DataFrame) -> DataFrame:
    """Up to two claims per change row: what came, and what went; each names the other as its counterpart."""
    sure = F.when(F.size(F.coalesce("refs", _refs())) > 0, SOURCE_CONFIDENCE[CHANGES + "_with_ref"]).otherwise(SOURCE_CONFIDENCE[CHANGES])
    came = F.struct(F.lit(ADD).alias("action"), F.col("added_ticker").alias("ticker"), F.col("added_name").alias("name"), F.col("removed_ticker").alias("counterpart_ticker"))
    went = F.struct(F.lit(REMOVE).alias("action"), F.col("removed_ticker").alias("ticker"), F.col("removed_name").alias("name"), F.col("added_ticker").alias("counterpart_ticker"))
    halves = F.filter(F.array(came, went), lambda h: F.coalesce(h["ticker"], F.lit("")) != "")
    return rows.withColumn("h", F.explode(halves)).select(
        "effective_date", "h.action", "h.ticker", "h.name", F.lit(CHANGES).alias("source_type"), sure.alias("confidence"), "reason", classify_reason(F.col("reason")).alias("reason_category"),
        "h.counterpart_ticker", F.concat(F.lit("changes table row "), F.col("row_index").cast("string")).alias("notes"), F.coalesce("refs", _refs()).alias("refs"),
    )


def _plain(rows: DataFrame, at: str, action: str, source: str, confidence: float, notes: str, reason: str = "", name: str | None = None) -> DataFrame:
    return rows.select(
        F.col(at).alias("effective_date"), F.lit(action).alias("action"), "ticker", (F.col(name) if name else F.lit("")).alias("name"), F.lit(source).alias("source_type"), F.lit(confidence).alias("confidence"),
        F.lit(reason).alias("reason"), F.lit(OTHER_REASON).alias("reason_category"), F.lit("").alias("counterpart_ticker"), F.lit(notes).alias("notes"), _refs().alias("refs"),
    )


def from_constituents(rows: DataFrame) -> DataFrame:
    """An ADD for each row with a date in the 'date added' column."""
    return _plain(rows.where(F.col("date_added").isNotNull()), "date_added", ADD, DATE_ADDED, SOURCE_CONFIDENCE[DATE_ADDED], "date added column", name="name")


def from_reference(snapshots: DataFrame) -> DataFrame:
    """ADDs and REMOVEs where labels appear in and vanish from the full lists (on_date, tickers)."""
    labels = snapshots.select("on_date", F.explode("tickers").alias("ticker"))
    spans = snapshots_to_intervals(labels, "ticker", "on_date")
    first = labels.agg(F.min("on_date").alias("_first"))
    spans = spans.crossJoin(F.broadcast(first))  # a row
    opening = spans.where(F.col("start") == F.col("_first"))
    sure = SOURCE_CONFIDENCE[REFERENCE]
    return (
        _plain(spans.where(F.col("start") > F.col("_first")), "start", ADD, REFERENCE, sure, "label first in a snapshot")
        .union(_plain(opening, "start", ADD, REFERENCE, SOURCE_CONFIDENCE[REFERENCE + "_opening"], "opening membership (left-censored)", "Member at the start of the data; it joined earlier."))
        .union(_plain(spans.where(F.col("end").isNotNull()), "end", REMOVE, REFERENCE, sure, "label gone from a snapshot"))
    )


def apply_overrides(claims: DataFrame, overrides: DataFrame) -> DataFrame:
    """claims without those of the changes table that an override suppresses, and with those that one adds."""
    o = overrides.withColumn("effective_date", F.to_date("effective_date")).withColumn("action", F.upper("action")).withColumn("ticker", F.upper("ticker"))
    dropped = o.where("mode = 'suppress'").select("effective_date", "action", "ticker", F.lit(CHANGES).alias("source_type")).distinct()
    kept = claims.join(dropped, ["effective_date", "action", "ticker", "source_type"], "left_anti").select(*claims.columns)
    reason = F.coalesce("reason", F.lit(""))
    added = o.where("mode = 'add'").select(
        "effective_date", "action", "ticker", F.col("company_name").alias("name"), F.lit(CURATED).alias("source_type"), F.coalesce(F.nullif(F.col("confidence").cast("double"), F.lit(0.0)), F.lit(SOURCE_CONFIDENCE[CURATED])).alias("confidence"),
        reason.alias("reason"), classify_reason(reason).alias("reason_category"), F.lit("").alias("counterpart_ticker"), F.concat(F.lit("curated override: "), F.coalesce("note", F.lit(""))).alias("notes"), _refs().alias("refs"),
    )
    return kept.unionByName(added, allowMissingColumns=True)


def split_at_changes(spans: DataFrame, changes: DataFrame, days: int = 45) -> DataFrame:
    """(ticker, start, end, position): a span that starts well before the change that brought its label is cut there."""
    c = changes.select(F.col("new_ticker").alias("ticker"), F.col("effective_date").alias("_at"), F.col("position"))
    hit = (F.col("start") < F.date_sub("_at", days)) & (F.col("end").isNull() | (F.col("end") > F.col("_at")))
    first = spans.join(c, "ticker").where(hit).groupBy("ticker", "start").agg(F.min_by("_at", "position").alias("_at"))
    cut = spans.join(first, ["ticker", "start"], "left")
    parts = F.when(F.col("_at").isNull(), F.array(F.struct("start", "end", F.lit("whole").alias("part")))).otherwise(
        F.array(F.struct("start", F.col("_at").alias("end"), F.lit("head").alias("part")), F.struct(F.col("_at").alias("start"), "end", F.lit("tail").alias("part")))
    )
    return cut.select("ticker", F.explode(parts).alias("p")).select("ticker", "p.start", "p.end", "p.part")


def without_bankruptcy_suffix(label):
    """The label before a trailing Q that marks an insolvent issuer; null for other labels."""
    return F.when(label.endswith("Q") & (F.length(label) >= 4) & ~label.contains("."), F.regexp_replace(label, "Q$", ""))


def from_unions(assigned: DataFrame) -> DataFrame:
    """Claims at the ends of each company's merged intervals (company_id, label, start, end)."""
    merged = union_intervals(assigned, ["company_id"], "start", "end", "label")
    ends = F.filter(F.array(F.struct(F.col("start").alias("effective_date"), F.lit(ADD).alias("action"), F.col("start_label").alias("ticker")), F.struct(F.col("end").alias("effective_date"), F.lit(REMOVE).alias("action"), F.col("end_label").alias("ticker"))), lambda x: x["effective_date"].isNotNull())
    return merged.select("company_id", F.explode(ends).alias("x")).select("company_id", "x.effective_date", "x.action", "x.ticker")


def retag_changes(claims: DataFrame, changed: DataFrame) -> DataFrame:
    """claims whose company changes its label that day count as TICKER_CHANGE."""
    marks = changed.select("company_id", "effective_date", F.lit(True).alias("_c")).distinct()
    hit = F.col("_c").isNotNull() & F.col("action").isin(ADD, REMOVE)
    return claims.join(marks, ["company_id", "effective_date"], "left").withColumn("action", F.when(hit, TICKER_CHANGE).otherwise(F.col("action"))).drop("_c")

"""From claims, dated sightings and reference lists to companies, events, intervals and issues.

Identity is resolved per component of observations (operators.identity); everything after it is set-based.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ADD, DATE_ADDED, REFERENCE, REMOVE, Settings
from ..functions.ids import event_id
from ..functions.text import normalize_name
from ..operators import claims as claim_ops
from ..operators import entities, identity, membership
from ..operators.graph import checkpointed, connected
from ..operators.temporal import overlap_flag, snapshots_to_intervals

_OUT = {
    "claims": "effective_date date, action string, ticker string, name string, source_type string, confidence double, reason string, reason_category string, counterpart_ticker string, notes string, refs array<string>, rank int, company_id string",
    "companies": "company_id string, canonical_name string, name_key string, cik string, needs_review boolean, notes string",
    "names": "company_id string, name string, first_seen date",
    "evidence": "company_id string, label string, on_date date, kind string",
    "moves": "company_id string, on_date date, action string, source_type string",
    "assigned": "company_id string, label string, start date, end date",
    "log": "op string, company_id string, ticker string, date date, rule string, loser string, winner string, old string, new string",
}
EMPTY_SIGHTINGS = "on_date date, ticker string, name string, cik string, kind string"


def _hints(curated: dict[str, DataFrame] | None) -> dict:
    """The hand-kept hints; the files are small and go to every task."""
    if not curated:
        return {}
    rows = lambda k: [r.asDict() for r in curated[k].orderBy("position").collect()] if k in curated else []
    changes = [{k: (v.isoformat() if isinstance(v, date) else v) for k, v in r.items()} for r in rows("ticker_changes")]
    return {"aliases": rows("aliases"), "ticker_changes": changes, "distinct": [r["name_key"] for r in curated["distinct"].collect()] if "distinct" in curated else []}


def _edges(spark: SparkSession, claims: DataFrame, sightings: DataFrame, intervals: DataFrame, hints: dict) -> DataFrame:
    """What can affect each other: labels (t:), name keys (n:), and the days (s:, p:) on which reference intervals meet
    each other or named claims, as edges. Those of a day are linked to the day, not to one another, so edges grow in
    proportion to the rows. Whether names are alike is only asked of holders of one label, and needs no edge."""
    label, key = lambda c: F.concat(F.lit("t:"), c), lambda c: F.concat(F.lit("n:"), c)
    aliases = {(identity.name_key(a["alias_name"]), other) for a in hints.get("aliases", []) for other in (identity.name_key(a["canonical_name"]), a.get("entity_key")) if other}
    by_alias = spark.createDataFrame([(f"n:{k}", f"n:{c}") for k, c in sorted(aliases)], "a string, b string")
    named = claims.select("ticker", "name").union(sightings.select("ticker", "name")).where(F.coalesce("name", F.lit("")) != "").distinct()
    by_name = named.select(label(F.col("ticker")).alias("a"), key(normalize_name(F.col("name"))).alias("b"))
    changed = [(f"t:{c['old_ticker']}", f"t:{c['new_ticker']}") for c in hints.get("ticker_changes", [])] + [(f"t:{c['new_ticker']}", f"n:{identity.name_key(c['company_name'])}") for c in hints.get("ticker_changes", [])]
    hinted = spark.createDataFrame(changed, "a string, b string")
    rows = claims.where((F.coalesce("counterpart_ticker", F.lit("")) != "") & ((F.col("reason_category") == identity.CHANGE_REASON) | F.col("ticker").isin([c["new_ticker"] for c in hints.get("ticker_changes", [])] or [""])))
    halves = rows.select(label(F.col("ticker")).alias("a"), label(F.col("counterpart_ticker")).alias("b"))
    came, went = intervals.select(F.lit(ADD).alias("action"), F.col("start").alias("d"), F.col("ticker").alias("t")), intervals.where(F.col("end").isNotNull()).select(F.lit(REMOVE).alias("action"), F.col("end").alias("d"), F.col("ticker").alias("t"))
    ends = came.union(went)
    both = ends.groupBy("d").agg(F.count_distinct("action").alias("n")).where("n = 2").select("d")
    swaps = ends.join(both, "d", "left_semi").select(label(F.col("t")).alias("a"), F.concat(F.lit("s:"), F.col("d").cast("string")).alias("b"))
    told = claims.where(~F.col("source_type").isin(DATE_ADDED, REFERENCE)).select("action", F.col("ticker").alias("t"), F.col("effective_date").alias("d"))
    listed = ends.select("action", "t", F.explode(F.sequence(F.date_sub("d", 13), F.date_add("d", 13))).alias("d")).distinct()
    free = told.join(listed, ["action", "t", "d"], "left_anti")
    near = ends.withColumn("d", F.explode(F.sequence(F.date_sub("d", 3), F.date_add("d", 3)))).join(free.select("action", "d").distinct(), ["action", "d"], "left_semi")
    # a claim is only ever paired with an interval's end: days without ends near them link nothing
    asked = free.join(near.select("action", "d").distinct(), ["action", "d"], "left_semi")
    pairs = near.select("action", "t", "d").union(asked.select("action", "t", "d")).select(label(F.col("t")).alias("a"), F.concat_ws(":", F.lit("p"), "action", F.col("d").cast("string")).alias("b"))
    suffix = intervals.where(F.col("ticker").endswith("Q") & (F.length("ticker") >= 4)).select(label(F.col("ticker")).alias("a"), label(claim_ops.without_bankruptcy_suffix(F.col("ticker"))).alias("b"))
    hidden = sightings.join(intervals.select("ticker").distinct(), "ticker", "left_anti").groupBy("ticker").agg(F.min("on_date").alias("first_seen"), F.max("on_date").alias("last_seen")).select(F.col("ticker").alias("entity"), "first_seen", "last_seen")
    shown = sightings.groupBy(F.col("ticker").alias("holder")).agg(F.min("on_date").alias("first_seen"))
    back = entities.backfilled(hidden, intervals.select(F.col("ticker").alias("holder"), "start", "end"), shown).select(label(F.col("a")).alias("a"), label(F.col("b")).alias("b"))
    alone = claims.select("ticker").union(sightings.select("ticker")).union(intervals.select("ticker")).distinct().select(label(F.col("ticker")).alias("a"), label(F.col("ticker")).alias("b"))
    return by_name.union(by_alias).union(hinted).union(halves).union(swaps).union(pairs).union(suffix).union(back).union(alone)


def resolve_identities(spark: SparkSession, claims: DataFrame, sightings: DataFrame, intervals: DataFrame, hints: dict, as_of: str) -> dict[str, DataFrame]:
    """The fold of operators.identity over each component; a table for each kind of result."""
    part = connected(_edges(spark, claims, sightings, intervals, hints)).where(F.col("node").startswith("t:")).select(F.substring("node", 3, 1_000_000).alias("ticker"), "component")
    rows = lambda df, kind: df.join(part, "ticker").select("component", F.lit(kind).alias("kind"), F.to_json(F.struct(*df.columns)).alias("row"))
    everything = rows(claims, "claim").union(rows(sightings, "sighting")).union(rows(intervals, "interval"))
    on = date.fromisoformat(as_of)

    def fold(of_one: list[tuple[str, str]]) -> list[tuple[str, str]]:
        held: dict[str, list[dict]] = {"claim": [], "sighting": [], "interval": []}
        for kind, row in sorted(of_one):
            r = json.loads(row)
            for k in ("effective_date", "on_date", "start", "end"):
                if r.get(k):
                    r[k] = date.fromisoformat(r[k])
            for k, default in (("name", ""), ("counterpart_ticker", ""), ("end", None)):
                r.setdefault(k, default)
            held[kind].append(r)
        return identity.to_json(identity.resolve(held["claim"], held["sighting"], held["interval"], hints, on))

    def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Components stand one after another; only one is held at a time, and results go out in portions."""
        made: list[tuple[str, str]] = []
        each = (r for pdf in batches for r in zip(pdf["component"], pdf["kind"], pdf["row"], strict=True))
        for _, of_one in groupby(each, key=lambda r: r[0]):
            made += fold([r[1:] for r in of_one])
            if len(made) >= 10_000:
                yield pd.DataFrame(made, columns=["kind", "row"])
                made = []
        yield pd.DataFrame(made, columns=["kind", "row"])

    # many small components share a call of Python; a fixed number of tasks, since their rows are few bytes but much work
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = everything.repartition(tasks, "component").sortWithinPartitions("component")
    out = checkpointed(dealt.mapInPandas(folded, "kind string, row string"))
    return {kind: out.where(F.col("kind") == kind).select(F.from_json("row", ddl).alias("x")).select("x.*") for kind, ddl in _OUT.items()}


def _content_id() -> Column:
    """A number by which ties fall, however the claims are dealt: what came before what went (of the halves of a change the
    new label's), then what was inferred, then the reference; among these a hash of all that a claim says. Equal claims share it."""
    said = ("company_id", "effective_date", "action", "ticker", "name", "source_type", "confidence", "reason", "reason_category", "counterpart_ticker", "notes", "refs")
    return F.shiftleft(F.col("rank").cast("long"), 61) + F.shiftrightunsigned(F.xxhash64(*said), 3)


def build(claims: DataFrame, sightings: DataFrame | None = None, snapshots: DataFrame | None = None, curated: dict[str, DataFrame] | None = None, as_of: str = "2026-01-01", settings: Settings = Settings()) -> dict[str, DataFrame]:  # noqa: B008
    """All tables of a build; events are those that the intervals rest on, by date, company and action.

    claims: rows of operators.claims.COLUMNS from named sources; sightings: (on_date, ticker, name, cik, kind) of dated
    lists, kind 'snapshot' or 'current'; snapshots: (on_date, tickers) of the reference; curated: sources.tables.curated.
    """
    spark = claims.sparkSession
    if curated and "overrides" in curated:
        claims = claim_ops.apply_overrides(claims, curated["overrides"])
    hints = _hints(curated)
    sightings = sightings if sightings is not None else spark.createDataFrame([], EMPTY_SIGHTINGS)
    if snapshots is not None:
        spans = snapshots_to_intervals(snapshots.select("on_date", F.explode("tickers").alias("ticker")), "ticker", "on_date")
        first = snapshots.agg(F.min("on_date").alias("_first"))
    else:
        spans, first = spark.createDataFrame([], "ticker string, start date, end date"), None
    # each is read a dozen times; what they come from may be long
    claims, sightings, spans = checkpointed(claims.select(*claim_ops.COLUMNS)), checkpointed(sightings), checkpointed(spans)
    t = resolve_identities(spark, claims, sightings, spans, hints, as_of)
    named = t["claims"]
    assigned = t["assigned"]
    # the reference speaks through the merged intervals of a company
    bounds = claim_ops.from_unions(assigned)
    if first is not None:
        bounds = bounds.crossJoin(F.broadcast(first))  # a row
    else:
        bounds = bounds.withColumn("_first", F.lit(None).cast("date"))
    opening = (F.col("action") == ADD) & (F.col("effective_date") == F.col("_first"))
    spoken = bounds.select(
        "effective_date", "action", "ticker", F.lit("").alias("name"), F.lit(REFERENCE).alias("source_type"), F.when(opening, 0.5).otherwise(0.6).alias("confidence"),
        F.when(opening, "Member at the start of the data; it joined earlier.").otherwise("").alias("reason"), F.lit("other_unknown").alias("reason_category"), F.lit("").alias("counterpart_ticker"),
        F.when(opening, "opening membership (left-censored); union of reference intervals").otherwise("union of reference intervals").alias("notes"), F.array().cast("array<string>").alias("refs"), F.lit(3).alias("rank"), "company_id",
    )
    inferred = named.where((F.col("action") == "TICKER_CHANGE") & ((F.col("source_type") == REFERENCE) | (F.col("notes") == "curated")))
    spoken = claim_ops.retag_changes(spoken, inferred)
    all_ = checkpointed(named.unionByName(spoken).where(F.col("company_id").isNotNull()).withColumn("claim_id", _content_id()).withColumn("label", F.col("ticker")))
    events = events_of(all_, t, as_of, settings)
    earliest = assigned.groupBy("company_id").agg(F.min("start").alias("earliest_reference"))
    intervals = membership.derive_intervals(events, earliest_reference=earliest)
    issues = membership.interval_issues(events, earliest_reference=earliest)
    if snapshots is not None:
        intervals = overlap_flag(intervals, assigned, "company_id")
        issues = issues.union(intervals.where("NOT supported").select("company_id", F.lit("unsupported_interval").alias("kind"), F.col("entry_date").alias("on_date")))
    else:
        intervals = intervals.withColumn("supported", F.lit(True))
    spans_ = entities.label_spans(t["evidence"], t["moves"], as_of)
    events = membership.kept_events(events, earliest_reference=earliest).orderBy("effective_date", "company_id", membership.action_order(F.col("action")), "event_id")
    intervals = intervals.orderBy(F.col("entry_date").asc_nulls_first(), "company_id")
    return {**t, "events": events, "intervals": intervals, "issues": issues, "tickers": spans_, "resolved": all_}


def events_of(claims: DataFrame, t: dict[str, DataFrame], as_of: str, settings: Settings) -> DataFrame:
    """Clustered and corroborated events with ids, counterparts and labels as of their dates."""
    keys = ["company_id", "action"]
    e = membership.corroborated(membership.anchored_clusters(claims, keys, "effective_date"), keys)
    more = claims.select("claim_id", "counterpart_ticker", "notes", "refs").dropDuplicates(["claim_id"])
    named = t["companies"].select("company_id", "canonical_name")
    e = e.join(more, "claim_id").join(named, "company_id", "left").withColumn("name", F.coalesce("name", "canonical_name")).drop("canonical_name")
    # today's label, in a 'date added' claim, isn't always the one of that day
    spans = entities.label_spans(t["evidence"], t["moves"], as_of).select(F.col("company_id").alias("_c"), F.col("label").alias("_l"), "valid_from", "valid_to")
    on = (F.col("company_id") == F.col("_c")) & (F.col("source_type") == DATE_ADDED) & (F.col("valid_from").isNull() | (F.col("valid_from") <= F.col("effective_date"))) & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.col("effective_date")))
    then = F.min(F.struct(F.coalesce("valid_from", F.to_date(F.lit("0001-01-01"))).alias("f"), F.col("_l").alias("l")))["l"].alias("_then")
    held = e.join(spans, on, "left").groupBy("claim_id", "company_id", "action").agg(then)
    e = e.join(held, ["claim_id", "company_id", "action"]).withColumn("label", F.coalesce("_then", "label")).drop("_then")
    asked = e.where((F.coalesce("counterpart_ticker", F.lit("")) != "") & F.col("action").isin(ADD, REMOVE)).select(F.col("counterpart_ticker").alias("label"), F.col("effective_date").alias("on_date")).distinct()
    other = entities.continuity(asked, t["evidence"], t["moves"].where(F.col("action") == REMOVE)).select(F.col("label").alias("counterpart_ticker"), F.col("on_date").alias("effective_date"), F.col("company_id").alias("_other"))
    e = e.join(other, ["counterpart_ticker", "effective_date"], "left").withColumn("counterpart_company_id", F.when(F.col("action").isin(ADD, REMOVE), F.col("_other"))).drop("_other")
    window = F.col("effective_date").between(F.to_date(F.lit(settings.window_start)), F.to_date(F.lit(settings.window_end)))
    censored: Column = F.coalesce(F.col("notes"), F.lit("")).contains("left-censored")
    return checkpointed(e.withColumn("event_id", event_id(F.col("company_id"), F.col("effective_date"), F.col("action"), F.col("label"))).withColumn("in_window", window).withColumn("left_censored", censored))



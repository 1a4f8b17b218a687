"""Set-based entity resolution: dated label evidence, continuity, pairing, redirects and label spans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import checkpointed
from ..config import ADD, CLUSTER_TOLERANCE_DAYS, CONTINUITY_DAYS, EVIDENCE_TIERS, EVIDENCE_WEIGHT, MEMBERSHIP_TOLERANCE_DAYS, PAIR_TOLERANCE_DAYS, REMOVE


def weight(kind: Column) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in EVIDENCE_WEIGHT.items() for x in pair]), kind)


def claim_bounds(claims: DataFrame, key: str = "company_id", at: str = "on_date") -> DataFrame:
    """(key, first_add, last_add, first_remove, last_remove)."""
    of = lambda action: F.when(F.col("action") == action, F.col(at))
    return claims.groupBy(key).agg(F.min(of(ADD)).alias("first_add"), F.max(of(ADD)).alias("last_add"), F.min(of(REMOVE)).alias("first_remove"), F.max(of(REMOVE)).alias("last_remove"))


def implausible(start: Column, end: Column, days: int = MEMBERSHIP_TOLERANCE_DAYS) -> Column:
    """Whether the bounds of claim_bounds() rule out membership from start to end."""
    after = F.col("last_remove").isNotNull() & (start > F.date_add("last_remove", days)) & ~F.coalesce(F.col("last_add") > F.col("last_remove"), F.lit(False))
    before = F.col("first_add").isNotNull() & end.isNotNull() & (end < F.date_sub("first_add", days)) & ~F.coalesce(F.col("first_remove") < F.col("first_add"), F.lit(False))
    return F.coalesce(after, F.lit(False)) | F.coalesce(before, F.lit(False))


def continuity(asked: DataFrame, evidence: DataFrame, removals: DataFrame, days: int = CONTINUITY_DAYS) -> DataFrame:
    """asked (label, on_date) with the company last or next seen under the label, within so many days, not removed between.

    Nearest sighting first, then company_id. A removal counts from the earlier of the two dates up to the later one.
    """
    # sightings are summed up per company, label and day; days are cut into blocks, so a popular label is many keys
    seen = evidence.select("company_id", "label", F.col("on_date").alias("seen")).distinct()
    block = lambda c: F.floor(F.unix_date(c) / days)
    near = seen.withColumn("_block", F.explode(F.array(block(F.col("seen")) - 1, block(F.col("seen")), block(F.col("seen")) + 1)))
    rows = asked.distinct().withColumn("_block", block(F.col("on_date"))).join(near, ["label", "_block"]).withColumn("gap", F.abs(F.datediff("on_date", "seen"))).where(F.col("gap") <= days)
    out = removals.select(F.col("company_id").alias("_c"), F.col("on_date").alias("_removed")).distinct()
    between = (F.col("company_id") == F.col("_c")) & (F.col("_removed") >= F.least("on_date", "seen")) & (F.col("_removed") < F.greatest("on_date", "seen"))
    held = rows.join(out, between, "left_anti")
    best = held.groupBy("label", "on_date").agg(F.min(F.struct("gap", "company_id")).alias("b"))
    return asked.join(best, ["label", "on_date"], "left").select(*asked.columns, F.col("b.company_id").alias("company_id"), F.col("b.gap").alias("gap"))


def score_intervals(intervals: DataFrame, evidence: DataFrame, days: int = MEMBERSHIP_TOLERANCE_DAYS) -> DataFrame:
    """Per interval (label, start, end) the company with the most weight of sightings about it; null if that is a tie.

    Without any sighting near it, the only company ever seen under the label.
    """
    daily = evidence.groupBy("company_id", "label", "on_date").agg(F.sum(weight(F.col("kind"))).alias("w"))
    inside = (F.col("on_date") >= F.date_sub("start", days)) & (F.col("end").isNull() | (F.col("on_date") <= F.date_add("end", days)))
    scored = intervals.join(daily, "label").groupBy("label", "start", "end", "company_id").agg(F.round(F.sum(F.when(inside, F.col("w")).otherwise(0.0)), 6).alias("score"))
    best = scored.groupBy("label", "start", "end").agg(F.max("score").alias("score"), F.max_by("company_id", "score").alias("company_id"), F.collect_list("score").alias("_all"))
    ties = F.size(F.filter("_all", lambda s: s == F.col("score")))
    rule = F.when((F.col("score") > 0) & (ties == 1), "ticker_evidence").when(F.col("score") > 0, "ambiguous_tie").when(F.size("_all") == 1, "ticker_unique_no_dated_evidence").otherwise("ambiguous_no_dated_evidence")
    known = best.withColumn("rule", rule).withColumn("company_id", F.when(~F.col("rule").startswith("ambiguous"), F.col("company_id")))
    keys = ["label", "start", "end"]
    cond = [F.col(f"i.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys]
    return intervals.alias("i").join(known.alias("k"), cond, "left").select("i.*", "k.company_id", "k.score", F.coalesce("k.rule", F.lit("no_candidate")).alias("rule"))


def pair_dates(left: DataFrame, right: DataFrame, key: str, near: int = PAIR_TOLERANCE_DAYS, clear: int = CLUSTER_TOLERANCE_DAYS) -> DataFrame:
    """Rows of left and right (key, label, on_date) that could be one event under two labels.

    At most `near` days apart, of different labels, and the right label must not itself occur on the left within
    `clear` days. Per left row the nearest, earliest, first-labelled one.
    """
    # a left row's own label is near it, so what is left to pair with depends on its day alone: one row a day is joined
    around = right.groupBy("label", "on_date").agg(F.min(F.struct(F.col(key).alias("k"))).alias("_key")).select("label", "on_date", "_key.k", F.lit(False).alias("_left"))
    listed = left.select("label", "on_date").distinct().select("label", "on_date", F.lit(None).cast(right.schema[key].dataType).alias("k"), F.lit(True).alias("_left"))
    reach = Window.partitionBy("label").orderBy(F.unix_date("on_date")).rangeBetween(-near - clear, near + clear)
    sides = around.union(listed).where(F.col("label").isNotNull() & F.col("on_date").isNotNull())
    placed = sides.withColumn("_near", F.collect_list(F.when(F.col("_left"), F.col("on_date"))).over(reach)).where(~F.col("_left"))
    spread = placed.select("_near", F.col("on_date").alias("other_date"), F.col("label").alias("other_label"), F.col("k").alias("other"), F.explode(F.sequence(F.date_sub("on_date", near), F.date_add("on_date", near))).alias("on_date"))
    taken = F.exists("_near", lambda d: F.abs(F.datediff(d, F.col("on_date"))) <= clear)
    gap = F.abs(F.datediff("on_date", "other_date"))
    free = spread.where(~taken).withColumn("_order", F.when(F.col("other_date") < F.col("on_date"), 2 * gap - 1).otherwise(2 * gap)).drop("_near")
    # the day is found by numbers, so that only its labels are sorted
    nearest = free.groupBy("on_date").agg(F.min("_order").alias("_order"))
    best = free.join(F.broadcast(nearest), ["on_date", "_order"]).groupBy("on_date").agg(F.min(F.struct(gap.alias("gap"), "other_date", "other_label", "other")).alias("p"))
    paired = left.distinct().where(F.col("label").isNotNull()).join(F.broadcast(best), "on_date")
    return paired.select(key, "label", "on_date", "p.gap", "p.other_date", "p.other_label", "p.other")


def same_day_swaps(moves: DataFrame, at: str = "on_date", label: str = "label", group: list[str] | None = None) -> DataFrame:
    """Days (of a group) on which exactly one label goes and exactly one other comes: (group, on_date, old, new)."""
    keys = [*(group or []), at]
    of = lambda action: F.when(F.col("action") == action, F.col(label))
    days = moves.where(F.col("action").isin(ADD, REMOVE)).groupBy(*keys).agg(F.min(of(REMOVE)).alias("old"), F.max(of(REMOVE)).alias("_o"), F.min(of(ADD)).alias("new"), F.max(of(ADD)).alias("_n"))
    return days.where((F.col("old") == F.col("_o")) & (F.col("new") == F.col("_n")) & (F.col("old") != F.col("new"))).select(*keys, "old", "new")


def backfilled(sightings: DataFrame, intervals: DataFrame, holders_seen: DataFrame, gap_days: int = CONTINUITY_DAYS + 31) -> DataFrame:
    """(a, b, gap): entities a whose whole sighting span lies in an interval of exactly one b that is only seen later.

    sightings: (entity, first_seen, last_seen); intervals: (holder, start, end); holders_seen: (holder, first_seen). The
    holders' first sightings follow the entity's last by at most gap_days, so the join is on blocks of so many days.
    """
    block = lambda c: F.floor(F.unix_date(c) / gap_days)
    b = holders_seen.select("holder", F.col("first_seen").alias("b_first")).withColumn("_block", F.explode(F.array(block(F.col("b_first")), block(F.col("b_first")) - 1)))
    pairs = sightings.withColumn("_block", block(F.col("last_seen"))).join(b, "_block").where((F.col("b_first") > F.col("last_seen")) & (F.datediff("b_first", "last_seen") <= gap_days) & (F.col("entity") != F.col("holder")))
    covering = (F.col("start") <= F.col("first_seen")) & (F.col("end").isNull() | (F.col("end") >= F.col("last_seen")))
    held = pairs.join(intervals, "holder").where(covering).select("entity", "holder", F.datediff("b_first", "last_seen").alias("gap")).distinct()
    one = held.groupBy("entity").agg(F.min("holder").alias("holder"), F.max("holder").alias("_last"), F.min("gap").alias("gap")).where(F.col("holder") == F.col("_last"))
    return one.select(F.col("entity").alias("a"), F.col("holder").alias("b"), "gap")


def roots(edges: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, root) of redirects (node, into), each followed to its end. Paths halve every round; cycles are refused."""
    now = edges.select("node", F.col("into").alias("root"))
    for _ in range(most_rounds):
        after = checkpointed(now.alias("x").join(now.alias("y"), F.col("x.root") == F.col("y.node"), "left").select("x.node", F.col("x.root").alias("was"), F.coalesce("y.root", "x.root").alias("root")))
        if not after.where("was <> root").limit(1).count():
            return after.select("node", "root")
        now = after.select("node", "root")
    raise ValueError("the redirects form a cycle")


def label_spans(evidence: DataFrame, claims: DataFrame, as_of: str, key: str = "company_id", label: str = "label", at: str = "on_date") -> DataFrame:
    """(key, label, valid_from, valid_to): when each label was in use, both ends included.

    The most reliable kinds that a label has decide on its first and last day. A label first seen after another's last
    day replaces it (on that day itself, if that sighting ended the label); the earliest label has no known start;
    labels without a successor are open if the key is a current member, else they end with their last day.
    """
    tiers = [F.col("kind").isin(*kinds) for kinds in EVIDENCE_TIERS]
    bounds = evidence.groupBy(key, label).agg(
        *[f(F.when(t, F.col(at))).alias(f"{n}{i}") for i, t in enumerate(tiers) for n, f in (("lo", F.min), ("hi", F.max))],
        F.max(F.when(F.col("kind").isin("remove", "curated"), F.col(at))).alias("_ended"), F.max(at).alias("_any"), F.collect_set(F.when(F.col("kind").isin("remove", "curated"), F.col(at))).alias("_ends"),
    )
    pick = lambda n: F.coalesce(*[F.when(F.col(f"lo{i}").isNotNull(), F.col(f"{n}{i}")) for i in range(len(tiers))])
    spans = bounds.select(key, label, pick("lo").alias("lo"), pick("hi").alias("hi"), "_any", "_ends").withColumn("_change", F.array_contains("_ends", F.col("hi")))
    order = Window.partitionBy(key).orderBy("lo", "hi", label)
    listed = spans.withColumn("_nth", F.row_number().over(order)).withColumn("_all", F.collect_list(F.struct("lo", F.lit(0))).over(order.rowsBetween(1, Window.unboundedFollowing)))
    later = F.array_min(F.transform(F.filter("_all", lambda x: (x["lo"] > F.col("hi")) | ((x["lo"] == F.col("hi")) & F.col("_change"))), lambda x: x["lo"]))
    member = claim_bounds(claims, key, at).select(key, "last_add", "last_remove")
    seen = evidence.groupBy(key).agg(F.max(at).alias("_last"))
    known = listed.join(seen, key).join(member, key, "left")
    current = F.col("last_remove").isNull() | F.coalesce(F.col("last_add") > F.col("last_remove"), F.lit(False)) | (F.col("_last") >= F.date_sub(F.to_date(F.lit(as_of)), CONTINUITY_DAYS))
    return known.select(key, label, F.when(F.col("_nth") > 1, F.col("lo")).alias("valid_from"), F.when(later.isNotNull(), F.date_sub(later, 1)).when(~current, F.col("hi")).alias("valid_to"))


def find(query: str, companies: DataFrame, labels: DataFrame, names: DataFrame, key: str = "company_id") -> DataFrame:
    """Keys that a query names: by id, else by label, else by a part of a name ('%' and '_' are live)."""
    q = query.strip()
    by_id = companies.where(F.col(key) == q).select(key, F.lit(1).alias("tier"))
    by_label = labels.where(F.col("label") == q.upper().replace("-", ".")).select(key, F.lit(2).alias("tier"))
    by_name = names.where(F.lower("name").like(f"%{q.lower()}%")).select(key, F.lit(3).alias("tier"))
    all_ = by_id.union(by_label).union(by_name).distinct()
    first = all_.agg(F.min("tier").alias("tier"))
    return all_.join(F.broadcast(first), "tier").select(key, "tier")  # a row


def alias_of(names: DataFrame, aliases: DataFrame, name: str, name_key: Column, alias_key: Column) -> DataFrame:
    """names with `canonical`: of the alias that is the name in other letter case, else of the first with its key."""
    exact = aliases.groupBy(F.lower(F.trim("alias_name")).alias("_exact")).agg(F.max_by("canonical_name", "position").alias("_by_exact"))
    keyed = aliases.groupBy(alias_key.alias("_norm")).agg(F.min_by("canonical_name", "position").alias("_by_key"))
    out = names.withColumn("_exact", F.lower(F.trim(name))).withColumn("_norm", name_key)
    return out.join(exact, "_exact", "left").join(keyed, "_norm", "left").withColumn("canonical", F.coalesce("_by_exact", "_by_key")).drop("_exact", "_norm", "_by_exact", "_by_key")


def curated_change(asked: DataFrame, changes: DataFrame, label: str = "new_ticker", days: int = MEMBERSHIP_TOLERANCE_DAYS) -> DataFrame:
    """asked (label, on_date) with the first change (by position) of that label within so many days."""
    near = changes.select(F.col(label).alias("label"), "old_ticker", "new_ticker", "effective_date", "position")
    hits = asked.distinct().join(near, "label").where(F.abs(F.datediff("on_date", "effective_date")) <= days)
    return hits.groupBy("label", "on_date").agg(F.min(F.struct("position", "old_ticker", "new_ticker", "effective_date")).alias("c")).select("label", "on_date", "c.old_ticker", "c.new_ticker", "c.effective_date")

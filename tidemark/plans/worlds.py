"""Adapters: the driver's tables as claims, intervals, observations and snapshots, each with the same as SQL (CTEs).

Claims (from `events`): a user is a company, a signup an ADD, an error a REMOVE, a purchase a TICKER_CHANGE.
Spells (from `orders`): a customer is a member from an order until 120 days later; spells that meet are merged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import REASONS, classify_reason
from ..operators.temporal import union_intervals

AS_OF = "2001-08-01"

#: Fixed texts that stand for reasons, taken in turn by event_id.
REASON_TEXTS = (
    "Ticker symbol changed from AB to CD.", "Beta acquired Alpha.", "Filed for Chapter 11 bankruptcy protection.", "Market capitalization changes.",
    "Spun off from Gamma Inc.", "", "Merged with Delta Corp.", "Taken private by investors.", "Moved to the S&P MidCap 400.", "No reason known", "Delisted from the exchange",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """Ints as longs, so that schemas don't depend on which function counted."""
    return df.select(*[F.col(c).cast("long").alias(c) if t in ("int", "smallint") else F.col(c) for c, t in df.dtypes])


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type").isin("signup", "error", "purchase"))
    four = F.col("event_id") % 4
    reason = F.element_at(F.array(*map(F.lit, REASON_TEXTS)), (F.col("event_id") % len(REASON_TEXTS) + 1).cast("int"))
    return e.select(
        "event_id", F.col("event_id").alias("claim_id"), F.col("user_id").alias("company_id"), F.to_date("ts").alias("effective_date"),
        F.when(F.col("event_type") == "signup", "ADD").when(F.col("event_type") == "error", "REMOVE").otherwise("TICKER_CHANGE").alias("action"),
        F.concat(F.lit("T"), (F.col("user_id") % 37).cast("string"), F.when(F.col("event_id") % 5 == 0, ".B").otherwise("")).alias("label"),
        F.when(four == 2, "").otherwise(F.concat(F.lit("Company "), F.col("user_id").cast("string"))).alias("name"),
        reason.alias("reason"), F.lit(False).alias("left_censored"),
        F.when(four == 1, "wikipedia_constituents").when(four == 2, "reference_fja05680").otherwise("wikipedia_changes").alias("source_type"),
        F.when(four == 0, 0.95).when(four == 1, 0.75).when(four == 2, 0.60).otherwise(0.90).alias("confidence"),
    ).withColumn("reason_category", classify_reason(F.col("reason")))


def _sql_reason() -> str:
    return "CASE event_id % " + str(len(REASON_TEXTS)) + " " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(REASON_TEXTS)) + " END"


def sql_classify(column: str) -> str:
    from ..functions.text import REASON_PATTERNS

    def pattern(p: str) -> str:
        return p.replace("'", "''")

    return f"CASE WHEN trim(coalesce({column}, '')) = '' THEN 'other_unknown' " + " ".join(f"WHEN regexp_matches({column}, '{pattern(p)}', 'i') THEN '{c}'" for c, p in REASON_PATTERNS) + " ELSE 'other_unknown' END"


CLAIMS_CTE = f"""
raw AS (SELECT event_id, user_id AS company_id, CAST(ts AS DATE) AS effective_date,
    CASE event_type WHEN 'signup' THEN 'ADD' WHEN 'error' THEN 'REMOVE' ELSE 'TICKER_CHANGE' END AS action,
    'T' || (user_id % 37) || CASE WHEN event_id % 5 = 0 THEN '.B' ELSE '' END AS label,
    CASE WHEN event_id % 4 = 2 THEN '' ELSE 'Company ' || user_id END AS name, {_sql_reason()} AS reason,
    CASE event_id % 4 WHEN 1 THEN 'wikipedia_constituents' WHEN 2 THEN 'reference_fja05680' ELSE 'wikipedia_changes' END AS source_type,
    CASE event_id % 4 WHEN 0 THEN 0.95::DOUBLE WHEN 1 THEN 0.75::DOUBLE WHEN 2 THEN 0.60::DOUBLE ELSE 0.90::DOUBLE END AS confidence
  FROM events WHERE event_type IN ('signup', 'error', 'purchase')),
claims AS (SELECT *, {sql_classify("reason")} AS reason_category FROM raw)"""

#: The state machine over claims: spells by the number of removals before, their opening and superseding ADDs.
SPELLS_CTE = (
    CLAIMS_CTE
    + """,
placed AS (
  SELECT *, coalesce(sum(CASE WHEN action = 'REMOVE' THEN 1 ELSE 0 END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS spell,
         row_number() OVER w AS nth
  FROM claims WHERE action IN ('ADD', 'REMOVE') WINDOW w AS (PARTITION BY company_id ORDER BY effective_date, CASE action WHEN 'ADD' THEN 0 ELSE 2 END, event_id)),
opened AS (
  SELECT p.*, o.nth AS open_nth, o.source_type AS open_source FROM placed p
  LEFT JOIN (SELECT company_id, spell, min(nth) AS nth, arg_min(source_type, nth) AS source_type FROM placed WHERE action = 'ADD' GROUP BY ALL) o USING (company_id, spell)),
overs AS (SELECT company_id, spell, min(nth) AS over_nth FROM opened WHERE action = 'ADD' AND open_source = 'wikipedia_constituents' AND source_type = 'wikipedia_changes' AND nth > open_nth GROUP BY ALL),
full_ AS (SELECT o.*, v.over_nth FROM opened o LEFT JOIN overs v USING (company_id, spell)),
spells AS (
  SELECT company_id, spell, any_value(coalesce(over_nth, open_nth)) AS e_nth,
         any_value(effective_date) FILTER (nth = coalesce(over_nth, open_nth)) AS e_at, any_value(event_id) FILTER (nth = coalesce(over_nth, open_nth)) AS e_id,
         any_value(label) FILTER (nth = coalesce(over_nth, open_nth)) AS e_label,
         any_value(effective_date) FILTER (action = 'REMOVE') AS r_at, any_value(event_id) FILTER (action = 'REMOVE') AS r_id, any_value(label) FILTER (action = 'REMOVE') AS r_label,
         any_value(reason_category) FILTER (action = 'REMOVE') AS r_category
  FROM full_ GROUP BY company_id, spell),
intervals AS (
  SELECT company_id, coalesce(e_at, CASE WHEN e_nth IS NULL THEN lag(r_at) OVER (PARTITION BY company_id ORDER BY spell) END) AS entry_date, r_at AS exit_date, e_id AS entry_event_id, r_id AS exit_event_id,
         coalesce(e_label, r_label) AS entry_ticker, coalesce(r_label, e_label) AS exit_ticker, coalesce(r_category, '') AS exit_reason_category, e_nth IS NULL AS left_censored
  FROM spells)"""
)


def spells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership intervals of customers."""
    o = table(spark, sf_dir, "orders")
    spans = o.select(F.col("o_custkey").alias("company_id"), F.to_date("o_orderdate").alias("start"), F.date_add(F.to_date("o_orderdate"), 120).alias("end"), F.col("o_orderpriority").alias("label"))
    u = union_intervals(spans, ["company_id"], "start", "end", "label", 10)
    ended = F.when(F.col("end") <= F.to_date(F.lit("2001-06-01")), F.col("end"))
    category = F.element_at(F.array(*map(F.lit, REASONS)), (F.col("company_id") % len(REASONS) + 1).cast("int"))
    return u.select(
        "company_id", F.col("start").alias("entry_date"), ended.alias("exit_date"), F.col("start_label").alias("entry_ticker"), F.col("end_label").alias("exit_ticker"),
        F.when(ended.isNotNull(), category).otherwise("").alias("exit_reason_category"), (F.col("start") < F.to_date(F.lit("1995-03-01"))).alias("left_censored"), (F.col("company_id") % 11 != 0).alias("supported"),
        F.when(ended.isNotNull(), F.concat_ws("-", F.col("company_id").cast("string"), ended.cast("string"))).alias("exit_event_id"),
    )


SPANS_CTE = """
o AS (SELECT o_custkey AS company_id, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + 120 AS fin, o_orderpriority AS label FROM orders),
m AS (SELECT *, max(fin) OVER (PARTITION BY company_id ORDER BY start, fin, label ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM o),
g AS (SELECT *, sum(CASE WHEN before IS NULL OR start - before > 10 THEN 1 ELSE 0 END) OVER (PARTITION BY company_id ORDER BY start, fin, label ROWS UNBOUNDED PRECEDING) AS grp FROM m),
u0 AS (SELECT company_id, grp, min(start) AS start, max(fin) AS fin FROM g GROUP BY ALL),
u AS (
  SELECT u0.company_id, u0.start, u0.fin,
         (SELECT min(label) FROM g WHERE g.company_id = u0.company_id AND g.grp = u0.grp AND g.start = u0.start) AS start_label,
         (SELECT min(label) FROM g WHERE g.company_id = u0.company_id AND g.grp = u0.grp AND g.fin = u0.fin) AS end_label
  FROM u0)"""

MEMBERS_CTE = (
    SPANS_CTE
    + """,
v AS (SELECT *, CASE WHEN fin <= DATE '2001-06-01' THEN fin END AS ended FROM u),
members AS (
  SELECT company_id, start AS entry_date, ended AS exit_date, start_label AS entry_ticker, end_label AS exit_ticker,
         CASE WHEN ended IS NOT NULL THEN CASE company_id % """
    + str(len(REASONS))
    + " "
    + " ".join(f"WHEN {i} THEN '{r}'" for i, r in enumerate(REASONS))
    + """ END ELSE '' END AS exit_reason_category,
         start < DATE '1995-03-01' AS left_censored, company_id % 11 <> 0 AS supported, CASE WHEN ended IS NOT NULL THEN company_id || '-' || ended END AS exit_event_id
  FROM v)"""
)


def build_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(claims, sightings) for plans.build: every customer's spells as named rows of a table of changes, a change of label
    within the spell that holds its day for each seventh customer, and a sighting on each 1 July. Every fourth removal has no name."""
    named = spells(spark, sf_dir).join(names(spark, sf_dir), "company_id").withColumn("renamed", F.date_add(F.to_date(F.lit("1998-01-01")), (F.col("company_id") % 300).cast("int")))
    inside = (F.col("company_id") % 7 == 0) & (F.col("entry_date") < F.date_sub("renamed", 40)) & (F.coalesce("exit_date", F.to_date(F.lit("9999-12-31"))) > F.date_add("renamed", 40))
    changes = named.where(inside).select("company_id", "company_name", "renamed")
    m = named.drop("renamed").join(changes.select("company_id", "renamed"), "company_id", "left")
    old, new = F.concat(F.lit("K"), F.col("company_id").cast("string")), F.concat(F.lit("N"), F.col("company_id").cast("string"))

    def label(on: str):
        return F.when(F.col(on) >= F.col("renamed"), new).otherwise(old)

    def rows(df: DataFrame, on: str, action: str, ticker, name, reason, other) -> DataFrame:
        return df.select(
            F.col(on).alias("effective_date"), F.lit(action).alias("action"), ticker.alias("ticker"), name.alias("name"), F.lit("wikipedia_changes").alias("source_type"), F.lit(0.9).alias("confidence"),
            reason.alias("reason"), other.alias("counterpart_ticker"), F.lit("").alias("notes"), F.array().cast("array<string>").alias("refs"),
        )

    none, why = F.lit(""), F.lit("Ticker symbol changed.")
    gone = F.when(F.col("company_id") % 4 == 0, "").otherwise(F.col("company_name"))
    claims_ = rows(m, "entry_date", "ADD", label("entry_date"), F.col("company_name"), none, none)
    claims_ = claims_.union(rows(m.where(F.col("exit_date").isNotNull()), "exit_date", "REMOVE", label("exit_date"), gone, F.lit("Market capitalization changes."), none))
    claims_ = claims_.union(rows(changes, "renamed", "ADD", new, F.col("company_name"), why, old)).union(rows(changes, "renamed", "REMOVE", old, F.col("company_name"), why, new))
    july = F.sequence(F.year("entry_date"), F.year(F.coalesce("exit_date", F.to_date(F.lit(AS_OF)))))
    seen = m.withColumn("y", F.explode(july)).withColumn("on_date", F.make_date("y", F.lit(7), F.lit(1))).where((F.col("on_date") >= F.col("entry_date")) & (F.col("on_date") < F.coalesce("exit_date", F.to_date(F.lit(AS_OF)))))
    sightings = seen.select("on_date", label("on_date").alias("ticker"), F.col("company_name").alias("name"), F.lit(None).cast("string").alias("cik"), F.lit("snapshot").alias("kind"))
    return claims_.withColumn("reason_category", classify_reason(F.col("reason"))), sightings


#: members, and labelled: those that a build gives for build_inputs(). A spell that begins while one is open is passed over.
BUILD_CTE = (
    MEMBERS_CTE
    + """,
b AS (SELECT m.*, c_name, DATE '1998-01-01' + CAST(company_id % 300 AS INTEGER) AS changed FROM members m JOIN customer ON c_custkey = company_id),
moved AS (SELECT company_id, c_name, changed FROM b WHERE company_id % 7 = 0 AND entry_date < changed - 40 AND coalesce(exit_date, DATE '9999-12-31') > changed + 40),
labelled AS (
  SELECT b.company_id, b.c_name AS company_name, b.entry_date, b.exit_date, moved.changed,
         CASE WHEN b.entry_date >= moved.changed THEN 'N' ELSE 'K' END || b.company_id AS entry_ticker,
         CASE WHEN b.exit_date >= moved.changed THEN 'N' WHEN b.exit_date IS NOT NULL THEN 'K' END || b.company_id AS exit_ticker
  FROM (SELECT *, coalesce(count(*) FILTER (WHERE exit_date IS NULL) OVER (PARTITION BY company_id ORDER BY entry_date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS open_before FROM b) b
       LEFT JOIN moved USING (company_id)
  WHERE open_before = 0)"""
)


def spell_events(members: DataFrame) -> DataFrame:
    """The ADDs and REMOVEs at the ends of the spells."""
    add = members.select("company_id", F.lit("ADD").alias("action"), F.col("entry_date").alias("effective_date"), F.col("entry_ticker").alias("label"), F.lit("").alias("reason_category"), F.lit(None).cast("string").alias("event_id"))
    gone = members.where(F.col("exit_date").isNotNull()).select("company_id", F.lit("REMOVE").alias("action"), F.col("exit_date").alias("effective_date"), F.col("exit_ticker").alias("label"), F.col("exit_reason_category").alias("reason_category"), F.col("exit_event_id").alias("event_id"))
    return add.union(gone).withColumn("reason", F.concat(F.lit("left: "), "reason_category")).withColumn("confidence", F.lit(0.9)).withColumn("source_type", F.lit("wikipedia_changes"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("company_name"))


NAMES_SQL = "(SELECT c_custkey AS company_id, c_name AS company_name FROM customer)"

"""All registered queries of the engine, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, ids, text
from ..operators import analytics, claims, entities, membership, reconcile, temporal
from . import worlds as w
from .build import build

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return w.tidy(f(spark, sf_dir))

        run.__name__, run.__doc__ = f.__name__, f.__doc__
        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return run

    return register


# -- claims, events, intervals ----------------------------------------------------------------------------------------


@query(
    f"""WITH {w.SPELLS_CTE} SELECT i.company_id, c.company_name, i.entry_ticker AS ticker, i.entry_date, i.exit_date, i.left_censored
    FROM intervals i JOIN {w.NAMES_SQL} c USING (company_id) WHERE (entry_date IS NULL OR entry_date <= DATE '2024-01-15') AND (exit_date IS NULL OR exit_date > DATE '2024-01-15')"""
)
def pit_constituents(spark, sf):
    """Who was a member on a day: claims, spells, stabbing, names."""
    on = F.to_date(F.lit("2024-01-15"))
    held = membership.derive_intervals(w.claims(spark, sf)).where(temporal.active(F.col("entry_date"), F.col("exit_date"), on))
    return held.join(w.names(spark, sf), "company_id").select("company_id", "company_name", F.col("entry_ticker").alias("ticker"), "entry_date", "exit_date", "left_censored")


@query(f"WITH {w.SPELLS_CTE} SELECT * FROM intervals")
def membership_intervals(spark, sf):
    return membership.derive_intervals(w.claims(spark, sf))


@query(
    f"""WITH {w.SPELLS_CTE} SELECT event_id, company_id, effective_date, action, label, source_type FROM full_ WHERE action = 'REMOVE' OR nth = coalesce(over_nth, open_nth)
    UNION ALL SELECT event_id, company_id, effective_date, action, label, source_type FROM claims WHERE action = 'TICKER_CHANGE'"""
)
def kept_events(spark, sf):
    return membership.kept_events(w.claims(spark, sf)).select("event_id", "company_id", "effective_date", "action", "label", "source_type")


@query(
    f"""WITH {w.SPELLS_CTE},
    issues AS (
      SELECT company_id, CASE WHEN nth = over_nth THEN 'entry_date_superseded' WHEN source_type = 'reference_fja05680' THEN 'duplicate_add' ELSE 'conflicting_entry_date' END AS kind, effective_date AS on_date
      FROM full_ WHERE action = 'ADD' AND nth > open_nth
      UNION ALL SELECT company_id, 'remove_without_add', effective_date FROM full_ WHERE action = 'REMOVE' AND open_nth IS NULL
      UNION ALL SELECT company_id, 'same_day_add_remove', exit_date FROM intervals WHERE entry_date = exit_date)
    SELECT * FROM issues"""
)
def interval_issues(spark, sf):
    return membership.interval_issues(w.claims(spark, sf))


@query(f"WITH {w.SPELLS_CTE} SELECT company_id, entry_date, exit_date FROM intervals WHERE entry_date = exit_date")
def zero_length_intervals(spark, sf):
    return membership.derive_intervals(w.claims(spark, sf)).where("entry_date = exit_date").select("company_id", "entry_date", "exit_date")


_CLUSTERS = (
    w.CLAIMS_CTE
    + """,
days AS (SELECT DISTINCT company_id, action, effective_date AS d FROM claims),
firsts AS (SELECT company_id, action, min(d) AS anchor FROM days GROUP BY ALL),
anchors AS (
  SELECT * FROM firsts
  UNION ALL
  SELECT a.company_id, a.action, (SELECT min(d) FROM days x WHERE x.company_id = a.company_id AND x.action = a.action AND x.d > a.anchor + 2) FROM anchors a
  WHERE (SELECT min(d) FROM days x WHERE x.company_id = a.company_id AND x.action = a.action AND x.d > a.anchor + 2) IS NOT NULL),
clustered AS (SELECT c.*, (SELECT max(anchor) FROM anchors a WHERE a.company_id = c.company_id AND a.action = c.action AND a.anchor <= c.effective_date) AS anchor FROM claims c)"""
)


@query(f"WITH RECURSIVE {_CLUSTERS} SELECT event_id, company_id, action, effective_date, anchor FROM clustered")
def claim_clusters(spark, sf):
    return membership.anchored_clusters(w.claims(spark, sf), ["company_id", "action"], "effective_date", 2).select("event_id", "company_id", "action", "effective_date", "anchor")


@query(
    f"""WITH RECURSIVE {_CLUSTERS},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY company_id, action, anchor ORDER BY confidence DESC, source_type <> 'reference_fja05680' DESC, name <> '' DESC, effective_date, event_id) AS best FROM clustered),
    others AS (SELECT r.company_id, r.action, r.anchor, list_sort(list_distinct(list(c.source_type) FILTER (c.source_type <> r.source_type))) AS o, count(*) AS n_claims,
        arg_min(c.name, (c.effective_date, -c.confidence, c.event_id)) FILTER (c.name <> '') AS any_name, arg_min(c.reason, (c.effective_date, -c.confidence, c.event_id)) FILTER (c.reason <> '') AS any_reason,
        arg_min(c.reason_category, (c.effective_date, -c.confidence, c.event_id)) FILTER (c.reason_category <> 'other_unknown') AS any_category
      FROM ranked r JOIN clustered c USING (company_id, action, anchor) WHERE r.best = 1 GROUP BY ALL)
    SELECT r.company_id, r.action, r.effective_date, r.label, coalesce(nullif(r.name, ''), any_name) AS name, coalesce(nullif(r.reason, ''), any_reason) AS reason,
           CASE WHEN r.reason_category <> 'other_unknown' THEN r.reason_category ELSE coalesce(any_category, 'other_unknown') END AS reason_category, r.source_type,
           round(least(0.99::DOUBLE, r.confidence + 0.05::DOUBLE * coalesce(len(o), 0)), 3) AS confidence, coalesce(array_to_string(o, ';'), '') AS corroborating_sources, n_claims,
           r.effective_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-25' AS in_window
    FROM ranked r JOIN others USING (company_id, action, anchor) WHERE r.best = 1"""
)
def corroborated_events(spark, sf):
    c = membership.anchored_clusters(w.claims(spark, sf), ["company_id", "action"], "effective_date", 2)
    e = membership.corroborated(c, ["company_id", "action"])
    window = F.col("effective_date").between(F.to_date(F.lit("2024-01-05")), F.to_date(F.lit("2024-01-25")))
    return e.drop("claim_id").withColumn("corroborating_sources", text.joined(F.col("corroborating_sources"))).withColumn("in_window", window)


@query(f"WITH {w.CLAIMS_CTE} SELECT event_id, 'E' || substr(sha1(concat_ws('|', company_id, effective_date, action, label)), 1, 14) AS stable_id, 'C' || substr(sha1(name), 1, 10) AS company_key, sha256(reason) AS reason_hash FROM claims")
def event_ids(spark, sf):
    c = w.claims(spark, sf)
    return c.select("event_id", ids.event_id(F.col("company_id"), F.col("effective_date"), F.col("action"), F.col("label")).alias("stable_id"), ids.company_id(F.col("name")).alias("company_key"), ids.content_hash(F.col("reason")).alias("reason_hash"))


@query(f"WITH {w.CLAIMS_CTE} SELECT event_id, effective_date, action, company_id, label, confidence, reason_category FROM claims WHERE effective_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' AND confidence >= 0.7 AND action IN ('ADD', 'REMOVE')")
def changes_in_range(spark, sf):
    out = temporal.changes_in_range(w.claims(spark, sf), "2024-01-10", "2024-01-20", ["ADD", "REMOVE"], 0.7)
    return out.select("event_id", "effective_date", "action", "company_id", "label", "confidence", "reason_category").orderBy("effective_date", "action", "label", "event_id")


@query(f"WITH {w.CLAIMS_CTE} SELECT reason, reason_category, count(*) AS n FROM claims GROUP BY ALL")
def classify_reason(spark, sf):
    return w.claims(spark, sf).groupBy("reason", "reason_category").agg(F.count("*").alias("n"))


_MONTHS = "SELECT DISTINCT o_custkey AS label, CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders"


def _months(spark, sf):
    return w.table(spark, sf, "orders").select(F.col("o_custkey").alias("label"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("on_date")).distinct()


@query(
    f"""WITH p AS ({_MONTHS}), n AS (SELECT d, row_number() OVER (ORDER BY d) AS k, lead(d) OVER (ORDER BY d) AS nxt FROM (SELECT DISTINCT d FROM p)),
    i AS (SELECT label, p.d, k, nxt, k - row_number() OVER (PARTITION BY label ORDER BY p.d) AS island FROM p JOIN n USING (d)),
    e AS (SELECT label, island, min(d) AS start, max(k) AS k FROM i GROUP BY ALL)
    SELECT label, start, nxt AS "end" FROM e JOIN n USING (k)"""
)
def snapshot_intervals(spark, sf):
    return temporal.snapshots_to_intervals(_months(spark, sf), "label", "on_date")


@query(f"WITH p AS ({_MONTHS}) SELECT d AS on_date, count(*) AS n, string_agg(label, ';' ORDER BY label) AS labels FROM p WHERE d = (SELECT max(d) FROM p WHERE d <= DATE '1998-06-15') GROUP BY d")
def snapshot_as_of(spark, sf):
    lists = _months(spark, sf).groupBy("on_date").agg(F.array_sort(F.collect_list("label")).alias("labels"))
    one = temporal.snapshot_as_of(lists, F.to_date(F.lit("1998-06-15")), "on_date", ["labels"])
    return one.select("on_date", F.size("labels").alias("n"), F.array_join(F.transform("labels", lambda x: x.cast("string")), ";").alias("labels"))


@query(
    f"""WITH p AS ({_MONTHS}), n AS (SELECT d, lag(d) OVER (ORDER BY d) AS prev, lead(d) OVER (ORDER BY d) AS nxt FROM (SELECT DISTINCT d FROM p))
    SELECT n.d AS on_date, p.label, 'came' AS change FROM p JOIN n USING (d) WHERE NOT EXISTS (SELECT 1 FROM p q WHERE q.d = n.prev AND q.label = p.label)
    UNION ALL SELECT n.nxt, p.label, 'went' FROM p JOIN n USING (d) WHERE n.nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p q WHERE q.d = n.nxt AND q.label = p.label)"""
)
def snapshot_changes(spark, sf):
    spans = temporal.snapshots_to_intervals(_months(spark, sf), "label", "on_date")
    ends = F.array(F.struct(F.col("start").alias("on_date"), F.lit("came").alias("change")), F.struct(F.col("end").alias("on_date"), F.lit("went").alias("change")))
    return spans.select("label", F.explode(ends).alias("x")).where(F.col("x.on_date").isNotNull()).select("x.on_date", "label", "x.change")


@query(f'WITH {w.SPANS_CTE} SELECT company_id, start, fin AS "end", start_label, end_label FROM u')
def union_intervals(spark, sf):
    o = w.table(spark, sf, "orders")
    spans = o.select(F.col("o_custkey").alias("company_id"), F.to_date("o_orderdate").alias("start"), F.date_add(F.to_date("o_orderdate"), 120).alias("end"), F.col("o_orderpriority").alias("label"))
    return temporal.union_intervals(spans, ["company_id"], "start", "end", "label", 10)


# -- as-of lookups ----------------------------------------------------------------------------------------------------

_SECTOR = """
obs AS (SELECT o_custkey AS company_id, o_orderkey, CAST(o_orderdate AS DATE) AS as_of_date, o_orderpriority AS sector FROM orders),
near AS (SELECT *, DATE '1998-06-01' - as_of_date AS gap FROM obs WHERE abs(DATE '1998-06-01' - as_of_date) <= 400),
pick AS (SELECT company_id, as_of_date, sector FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY gap < 0, abs(gap), o_orderkey) AS k FROM near) WHERE k = 1)"""


def _sectors(spark, sf):
    obs = w.table(spark, sf, "orders").select(F.col("o_custkey").alias("company_id"), "o_orderkey", F.to_date("o_orderdate").alias("as_of_date"), F.col("o_orderpriority").alias("sector"))
    return temporal.nearest_as_of(obs, F.to_date(F.lit("1998-06-01")), "company_id", "as_of_date", ["sector"], tie="o_orderkey")


@query(f"WITH {_SECTOR} SELECT * FROM pick")
def sector_as_of(spark, sf):
    return _sectors(spark, sf)


def _members_on(spark, sf):
    on = F.to_date(F.lit("1998-06-01"))
    held = w.spells(spark, sf).where(temporal.active(F.col("entry_date"), F.col("exit_date"), on, F.col("supported")))
    return held.join(_sectors(spark, sf), "company_id", "left")


_MEMBERS_ON = f"{w.MEMBERS_CTE}, {_SECTOR}, held AS (SELECT m.*, pick.as_of_date, pick.sector FROM members m LEFT JOIN pick USING (company_id) WHERE entry_date <= DATE '1998-06-01' AND (exit_date IS NULL OR exit_date > DATE '1998-06-01') AND supported)"


@query(f"WITH {_MEMBERS_ON} SELECT company_id, company_name, entry_ticker AS tickers, entry_date, exit_date, left_censored, supported, sector, as_of_date AS sector_as_of FROM held JOIN {w.NAMES_SQL} USING (company_id)")
def constituents_with_sector(spark, sf):
    m = _members_on(spark, sf).join(w.names(spark, sf), "company_id")
    return m.select("company_id", "company_name", F.col("entry_ticker").alias("tickers"), "entry_date", "exit_date", "left_censored", "supported", "sector", F.col("as_of_date").alias("sector_as_of")).orderBy("tickers", "company_id")


@query(f"WITH {_MEMBERS_ON}, c AS (SELECT coalesce(sector, 'Unknown / not observed') AS sector, count(*) AS count FROM held GROUP BY 1) SELECT sector, count, round(100.0::DOUBLE * count / (sum(count) OVER ()), 2) AS pct FROM c")
def sector_composition(spark, sf):
    return analytics.composition(_members_on(spark, sf), "sector")


_EVIDENCE = """
ev AS (SELECT user_id AS company_id, 'L' || (event_id % 3) AS label, CAST(ts AS DATE) AS on_date,
         CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'remove' WHEN 'view' THEN 'reference' WHEN 'click' THEN 'snapshot' ELSE 'curated' END AS kind, event_id FROM events),
cl AS (SELECT user_id AS company_id, CAST(ts AS DATE) AS on_date, CASE event_type WHEN 'signup' THEN 'ADD' ELSE 'REMOVE' END AS action FROM events WHERE event_type IN ('signup', 'error'))"""


def _evidence(spark, sf):
    e = w.table(spark, sf, "events")
    kind = F.when(F.col("event_type") == "signup", "add").when(F.col("event_type") == "error", "remove").when(F.col("event_type") == "view", "reference").when(F.col("event_type") == "click", "snapshot").otherwise("curated")
    return e.select(F.col("user_id").alias("company_id"), F.concat(F.lit("L"), (F.col("event_id") % 3).cast("string")).alias("label"), F.to_date("ts").alias("on_date"), kind.alias("kind"))


def _moves(spark, sf):
    c = w.claims(spark, sf).where(F.col("action") != "TICKER_CHANGE")
    return c.select("company_id", "label", F.col("effective_date").alias("on_date"), "action")


_SPANS = (
    _EVIDENCE
    + """,
tiers AS (SELECT company_id, label, min(on_date) FILTER (kind IN ('snapshot','remove','curated')) AS lo0, max(on_date) FILTER (kind IN ('snapshot','remove','curated')) AS hi0,
    min(on_date) FILTER (kind = 'reference') AS lo1, max(on_date) FILTER (kind = 'reference') AS hi1, min(on_date) FILTER (kind = 'add') AS lo2, max(on_date) FILTER (kind = 'add') AS hi2 FROM ev GROUP BY ALL),
b AS (SELECT company_id, label, coalesce(lo0, lo1, lo2) AS lo, CASE WHEN lo0 IS NOT NULL THEN hi0 WHEN lo1 IS NOT NULL THEN hi1 ELSE hi2 END AS hi FROM tiers),
n AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY lo, hi, label) AS nth, EXISTS (SELECT 1 FROM ev WHERE ev.company_id = b.company_id AND ev.label = b.label AND ev.on_date = b.hi AND kind IN ('remove','curated')) AS chg FROM b),
mem AS (SELECT company_id, max(on_date) FILTER (action = 'ADD') AS last_add, max(on_date) FILTER (action = 'REMOVE') AS last_remove FROM cl GROUP BY 1),
lastev AS (SELECT company_id, max(on_date) AS le FROM ev GROUP BY 1),
spans AS (
  SELECT n.company_id, n.label, CASE WHEN n.nth > 1 THEN n.lo END AS valid_from,
    CASE WHEN (SELECT min(x.lo) FROM n x WHERE x.company_id = n.company_id AND x.nth > n.nth AND (x.lo > n.hi OR (x.lo = n.hi AND n.chg))) IS NOT NULL
         THEN (SELECT min(x.lo) FROM n x WHERE x.company_id = n.company_id AND x.nth > n.nth AND (x.lo > n.hi OR (x.lo = n.hi AND n.chg))) - 1
         WHEN NOT (last_remove IS NULL OR coalesce(last_add > last_remove, false) OR le >= DATE '2026-01-01' - 400) THEN n.hi END AS valid_to
  FROM n LEFT JOIN mem USING (company_id) JOIN lastev USING (company_id))"""
)


@query(f"WITH {_SPANS} SELECT * FROM spans")
def ticker_spans(spark, sf):
    return entities.label_spans(_evidence(spark, sf), _moves(spark, sf), "2026-01-01")


@query(f"WITH {_SPANS} SELECT company_id, string_agg(label, ';' ORDER BY label) AS tickers FROM spans WHERE (valid_from IS NULL OR valid_from <= DATE '2024-01-20') AND (valid_to IS NULL OR valid_to >= DATE '2024-01-20') GROUP BY 1")
def ticker_as_of(spark, sf):
    spans = entities.label_spans(_evidence(spark, sf), _moves(spark, sf), "2026-01-01")
    return temporal.labels_as_of(spans, F.to_date(F.lit("2024-01-20")), label="label").select("company_id", text.joined(F.col("tickers")).alias("tickers"))


# -- analytics --------------------------------------------------------------------------------------------------------


@query(
    f"""WITH {w.MEMBERS_CTE}, y AS (SELECT range::BIGINT AS year FROM range(1995, 2002)), d AS (SELECT year, CASE WHEN year < 2001 THEN make_date(year, 12, 31) ELSE DATE '{w.AS_OF}' END AS on_date FROM y)
    SELECT year, (SELECT count(*) FROM members WHERE year(entry_date) = d.year) AS additions, (SELECT count(*) FROM members WHERE year(exit_date) = d.year) AS removals,
      (SELECT count(*) FROM members WHERE supported AND entry_date <= on_date AND (exit_date IS NULL OR exit_date > on_date)) AS members_at_year_end,
      CASE WHEN (SELECT count(*) FROM members WHERE supported AND entry_date <= on_date AND (exit_date IS NULL OR exit_date > on_date)) > 0
        THEN round(100.0::DOUBLE * (SELECT count(*) FROM members WHERE year(exit_date) = d.year) / (SELECT count(*) FROM members WHERE supported AND entry_date <= on_date AND (exit_date IS NULL OR exit_date > on_date)), 2) END AS turnover_pct
    FROM d"""
)
def turnover_by_year(spark, sf):
    m = w.spells(spark, sf)
    return analytics.turnover(w.spell_events(m), m.where("supported"), 1995, w.AS_OF)


@query(f"WITH {w.MEMBERS_CTE} SELECT year(exit_date)::BIGINT AS year, " + ", ".join(f"nullif(count(*) FILTER (exit_reason_category = '{r}'), 0) AS {r}" for r in text.REASONS) + " FROM members WHERE exit_date IS NOT NULL AND year(exit_date) >= 1996 GROUP BY 1")
def exit_reasons_by_year(spark, sf):
    return analytics.pivot_by_year(w.spell_events(w.spells(spark, sf)), "reason_category", list(text.REASONS), 1996)


@query(
    f"""WITH {w.MEMBERS_CTE} SELECT company_id, company_name, entry_date, exit_date, left_censored, (coalesce(exit_date, DATE '{w.AS_OF}') - entry_date)::BIGINT AS days,
    round((coalesce(exit_date, DATE '{w.AS_OF}') - entry_date)::DOUBLE / 365.25::DOUBLE, 2) AS years FROM members JOIN {w.NAMES_SQL} USING (company_id) WHERE supported ORDER BY days DESC, company_id, entry_date LIMIT 25"""
)
def longest_memberships(spark, sf):
    return analytics.longest(w.spells(spark, sf), w.names(spark, sf), w.AS_OF)


@query(
    f"""WITH {w.MEMBERS_CTE} SELECT company_id, company_name, exit_ticker, entry_date, exit_date, exit_reason_category, 'left: ' || exit_reason_category AS reason, 'wikipedia_changes' AS exit_source, 0.9::DOUBLE AS confidence,
    (exit_date - entry_date)::BIGINT AS days_in_index FROM members JOIN {w.NAMES_SQL} USING (company_id) WHERE supported AND exit_date BETWEEN DATE '1998-01-01' AND DATE '1998-12-31'"""
)
def exited_between(spark, sf):
    m = w.spells(spark, sf)
    gone = w.spell_events(m).where("event_id IS NOT NULL")
    return analytics.exited(m, w.names(spark, sf), gone, "1998-01-01", "1998-12-31").orderBy("exit_date", "company_id")


@query(
    f"""WITH {w.MEMBERS_CTE}, k AS (SELECT *, exit_date IS NOT NULL AND NOT left_censored AS done FROM members WHERE supported), s AS (SELECT (exit_date - entry_date)::DOUBLE / 365.25::DOUBLE AS y, row_number() OVER (ORDER BY exit_date - entry_date) AS r, count(*) OVER () AS n FROM k WHERE done)
    SELECT count(*) AS n_intervals, count(*) FILTER (done) AS n_completed, count(*) FILTER (exit_date IS NULL AND NOT left_censored) AS n_ongoing, count(*) FILTER (left_censored) AS n_left_censored,
      (SELECT round(avg(y), 2) FROM s) AS mean_completed_years, (SELECT round(y, 2) FROM s WHERE r = n // 2 + 1) AS median_completed_years FROM k"""
)
def duration_stats(spark, sf):
    return analytics.duration_stats(w.spells(spark, sf), w.AS_OF)


@query(
    f"""WITH {w.MEMBERS_CTE}, k AS (SELECT (floor((exit_date - entry_date)::DOUBLE / 365.25::DOUBLE / 1) * 1)::BIGINT AS bin FROM members WHERE supported AND exit_date IS NOT NULL AND NOT left_censored)
    SELECT bin, bin || '-' || (bin + 1) || 'y' AS label, count(*) AS count FROM k GROUP BY ALL"""
)
def duration_histogram(spark, sf):
    return analytics.duration_histogram(w.spells(spark, sf), 1)


@query(
    f"""WITH {w.MEMBERS_CTE}, t AS (SELECT coalesce(exit_date, DATE '{w.AS_OF}') - entry_date AS days, count(*) AS c, count(exit_date) AS d FROM members WHERE supported AND entry_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31' GROUP BY 1),
    r AS (SELECT *, sum(c) OVER (ORDER BY days DESC) AS n FROM t), s AS (SELECT days, product(1 - d::DOUBLE / n) OVER (ORDER BY days) AS s, d, n FROM r)
    SELECT round(days::DOUBLE / 365.25::DOUBLE, 3) AS years, round(s, 4) AS survival, n::BIGINT AS at_risk FROM s WHERE d > 0 AND round(days::DOUBLE / 365.25::DOUBLE, 3) <= 5
    UNION ALL SELECT 0.0, 1.0, (SELECT coalesce(sum(c), 0)::BIGINT FROM t)"""
)
def survival_curve(spark, sf):
    return analytics.survival(w.spells(spark, sf), "1995-01-01", "1996-12-31", w.AS_OF, 5)


@query(
    f"""WITH {w.MEMBERS_CTE}, l AS (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY entry_date DESC) AS k FROM members WHERE supported)
    SELECT company_id, company_name, exit_ticker, entry_date, exit_date, exit_reason_category, round((exit_date - entry_date)::DOUBLE / 365.25::DOUBLE, 2) AS years_in_index, left_censored
    FROM l JOIN {w.NAMES_SQL} USING (company_id) WHERE k = 1 AND exit_date IS NOT NULL ORDER BY exit_date DESC, company_id LIMIT 2000"""
)
def cemetery(spark, sf):
    return analytics.cemetery(w.spells(spark, sf), w.names(spark, sf))


@query(
    f"""WITH {w.MEMBERS_CTE} SELECT on_date, count(*) AS members FROM (SELECT last_day(make_date(y, q, 1)) AS on_date FROM range(1996, 2001) a(y), (VALUES (3), (6), (9), (12)) b(q)) JOIN members ON entry_date <= on_date AND (exit_date IS NULL OR exit_date > on_date) GROUP BY 1"""
)
def members_by_quarter(spark, sf):
    return temporal.stab(dates.quarter_ends(spark, "1996-01-01", "2000-12-31"), w.spells(spark, sf)).groupBy("on_date").agg(F.count("*").alias("members"))


@query("SELECT last_day(make_date(y, q, 1)) AS on_date FROM range(2001, 2027) a(y), (VALUES (3), (6), (9), (12)) b(q) WHERE last_day(make_date(y, q, 1)) BETWEEN DATE '2001-01-01' AND DATE '2026-11-26'")
def quarter_ends(spark, sf):
    return dates.quarter_ends(spark, "2001-01-01", "2026-11-26")


@query("SELECT CASE WHEN y = 2007 THEN DATE '2007-07-01' ELSE make_date(y, 1, 1) END AS on_date FROM range(2001, 2027) a(y)")
def snapshot_calendar(spark, sf):
    return dates.new_years(spark, 2001, 2026)


@query(
    f"""WITH {w.SPELLS_CTE}, i AS (SELECT CASE WHEN nth = over_nth THEN 'entry_date_superseded' WHEN source_type = 'reference_fja05680' THEN 'duplicate_add' ELSE 'conflicting_entry_date' END AS kind FROM full_ WHERE action = 'ADD' AND nth > open_nth
      UNION ALL SELECT 'remove_without_add' FROM full_ WHERE action = 'REMOVE' AND open_nth IS NULL UNION ALL SELECT 'same_day_add_remove' FROM intervals WHERE entry_date = exit_date)
    SELECT kind, count(*) AS n FROM i GROUP BY 1"""
)
def data_quality(spark, sf):
    return analytics.issue_counts(membership.interval_issues(w.claims(spark, sf)))


# -- reconciliation ---------------------------------------------------------------------------------------------------

_SIDES = """
ours AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, o_custkey AS company_id FROM orders WHERE o_orderkey % 10 <> 0),
theirs AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, o_custkey AS company_id FROM orders WHERE o_orderkey % 10 <> 1),
diff AS (SELECT *, 'extra_in_ours' AS kind FROM (SELECT * FROM ours EXCEPT SELECT * FROM theirs) UNION ALL SELECT *, 'missing_in_ours' FROM (SELECT * FROM theirs EXCEPT SELECT * FROM ours))"""


def _sides(spark, sf):
    o = w.table(spark, sf, "orders").select("o_orderkey", F.to_date(F.date_trunc("month", "o_orderdate")).alias("on_date"), F.col("o_custkey").alias("company_id"))
    return o.where("o_orderkey % 10 <> 0").drop("o_orderkey"), o.where("o_orderkey % 10 <> 1").drop("o_orderkey")


@query(f"WITH {_SIDES} SELECT d AS on_date, company_id, 'reference_company' AS comparison, kind FROM diff")
def reconcile_missing_extra(spark, sf):
    ours, theirs = _sides(spark, sf)
    return reconcile.differences(ours, theirs, ["on_date", "company_id"], "reference_company")


@query(
    """WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d, 'L' || o_custkey % 97 || 'B' AS t, o_orderkey AS k FROM orders),
    x AS (SELECT DISTINCT d, t FROM o WHERE k % 10 <> 0), y AS (SELECT DISTINCT d, t FROM o WHERE k % 10 <> 1)
    SELECT d AS on_date, t AS ticker, 'page_ticker' AS comparison, 'extra_in_ours' AS kind FROM (SELECT * FROM x EXCEPT SELECT * FROM y)
    UNION ALL SELECT d, t, 'page_ticker', 'missing_in_ours' FROM (SELECT * FROM y EXCEPT SELECT * FROM x)"""
)
def reconcile_labels(spark, sf):
    """Label by label, by compare keys: one side writes a share class with a point, the other with a hyphen in small letters."""
    ours, theirs = _sides(spark, sf)
    number = (F.col("company_id") % 97).cast("string")
    mine = ours.select("on_date", text.compare_key(F.concat(F.lit("L"), number, F.lit(".B"))).alias("ticker"))
    shown = theirs.select("on_date", text.compare_key(F.concat(F.lit("l"), number, F.lit("-b"))).alias("ticker"))
    return reconcile.differences(mine, shown, ["on_date", "ticker"], "page_ticker")


@query(f"WITH {_SIDES}, d2 AS (SELECT d FROM ours UNION SELECT d FROM theirs) SELECT d AS on_date, (SELECT count(*) FROM ours WHERE ours.d = d2.d) AS ours, (SELECT count(*) FROM theirs WHERE theirs.d = d2.d) AS theirs, (SELECT count(*) FROM diff WHERE diff.d = d2.d AND kind = 'missing_in_ours') AS missing, (SELECT count(*) FROM diff WHERE diff.d = d2.d AND kind = 'extra_in_ours') AS extra FROM d2")
def reconcile_tallies(spark, sf):
    ours, theirs = _sides(spark, sf)
    return reconcile.tallies(ours, theirs, "on_date", ["company_id"])


_RANGES = f"{_SIDES}, ranges AS (SELECT 'reference_company' AS comparison, kind, company_id, min(d) AS first_date, max(d) AS last_date, count(*) AS n_dates, CASE WHEN max(d) - min(d) <= 10 THEN 'minor_date_disagreement' ELSE 'membership' END AS severity FROM diff GROUP BY kind, company_id)"


@query(f"WITH {_RANGES} SELECT * FROM ranges")
def discrepancy_ranges(spark, sf):
    ours, theirs = _sides(spark, sf)
    return reconcile.collapse(reconcile.differences(ours, theirs, ["on_date", "company_id"], "reference_company"), ["company_id"], "on_date")


@query(f"WITH {_RANGES} SELECT comparison, severity, kind, count(*) AS n FROM ranges GROUP BY ALL")
def discrepancy_counts(spark, sf):
    ours, theirs = _sides(spark, sf)
    return analytics.discrepancy_counts(reconcile.collapse(reconcile.differences(ours, theirs, ["on_date", "company_id"], "reference_company"), ["company_id"], "on_date"))


@query("WITH l AS (SELECT p_type AS owner, replace(upper(p_name), '-', '') || p_size AS tkey FROM part) SELECT tkey, min(owner) AS owner FROM l GROUP BY tkey HAVING min(owner) = max(owner)")
def unique_label_owner(spark, sf):
    parts = w.table(spark, sf, "part")
    return reconcile.unique_owner(parts, "p_name", "p_type", text.compare_key(F.concat_ws("-", "p_name", "p_size"))).withColumnRenamed("p_type", "owner")


# -- pairing and identity ---------------------------------------------------------------------------------------------


@query(
    f"""WITH {w.MEMBERS_CTE}, r AS (SELECT o_custkey AS company_id, CAST(o_orderdate AS DATE) AS start, CAST(o_orderdate AS DATE) + 30 AS fin FROM orders WHERE o_orderpriority = '1-URGENT')
    SELECT company_id, entry_date, exit_date, EXISTS (SELECT 1 FROM r WHERE r.company_id = m.company_id AND (exit_date IS NULL OR r.start <= exit_date + 10) AND r.fin >= entry_date - 10) AS supported FROM members m"""
)
def support_flag(spark, sf):
    o = w.table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("company_id"), F.to_date("o_orderdate").alias("start"), F.date_add(F.to_date("o_orderdate"), 30).alias("end"))
    return temporal.overlap_flag(w.spells(spark, sf).select("company_id", "entry_date", "exit_date"), o, "company_id")


_PAIRS = """
o AS (SELECT DISTINCT o_orderstatus, o_custkey AS k, o_orderpriority || '-' || o_custkey AS label, CAST(o_orderdate AS DATE) AS d FROM orders),
l AS (SELECT * FROM o WHERE o_orderstatus = 'F'), near AS (SELECT DISTINCT label, d + i::INTEGER AS d FROM l, range(-10, 11) s(i)),
r AS (SELECT k AS other, label AS other_label, d AS other_date, d + i::INTEGER AS d FROM o, range(-3, 4) s(i) WHERE o_orderstatus = 'O'),
pairs AS (SELECT l.k, l.label, l.d, r.other, r.other_label, r.other_date, abs(l.d - r.other_date) AS gap FROM l JOIN r ON l.d = r.d AND l.label <> r.other_label
  WHERE NOT EXISTS (SELECT 1 FROM near x WHERE x.label = r.other_label AND x.d = l.d))"""


@query(f"WITH {_PAIRS} SELECT k AS company_id, label, d AS on_date, gap::BIGINT AS gap, other_date, other_label, other FROM (SELECT *, row_number() OVER (PARTITION BY k, label, d ORDER BY gap, other_date, other_label, other) AS n FROM pairs) WHERE n = 1")
def band_pairing(spark, sf):
    """All finished orders against all open ones, priority and customer as label."""
    o = w.table(spark, sf, "orders").select("o_orderstatus", F.col("o_custkey").alias("company_id"), F.concat_ws("-", "o_orderpriority", "o_custkey").alias("label"), F.to_date("o_orderdate").alias("on_date"))
    left, right = o.where("o_orderstatus = 'F'").drop("o_orderstatus"), o.where("o_orderstatus = 'O'").drop("o_orderstatus")
    return entities.pair_dates(left, right, "company_id")


@query(
    f"""WITH {w.CLAIMS_CTE}, d AS (SELECT company_id, effective_date AS on_date, min(label) FILTER (action = 'REMOVE') AS old, max(label) FILTER (action = 'REMOVE') AS o2, min(label) FILTER (action = 'ADD') AS new, max(label) FILTER (action = 'ADD') AS n2 FROM claims GROUP BY ALL)
    SELECT company_id, on_date, old, new FROM d WHERE old = o2 AND new = n2 AND old <> new"""
)
def same_day_swap(spark, sf):
    return entities.same_day_swaps(_moves(spark, sf), group=["company_id"])


@query(
    f"""WITH {_EVIDENCE}, asked AS (SELECT DISTINCT 'L' || (o_custkey % 3) AS label, DATE '2024-01-01' + (o_orderkey % 30)::INTEGER AS on_date FROM orders),
    near AS (SELECT DISTINCT a.label, a.on_date, ev.company_id, ev.on_date AS seen, abs(a.on_date - ev.on_date) AS gap FROM asked a JOIN ev ON a.label = ev.label AND abs(a.on_date - ev.on_date) <= 5
      WHERE NOT EXISTS (SELECT 1 FROM cl WHERE action = 'REMOVE' AND cl.company_id = ev.company_id AND cl.on_date >= least(a.on_date, ev.on_date) AND cl.on_date < greatest(a.on_date, ev.on_date))),
    best AS (SELECT *, row_number() OVER (PARTITION BY label, on_date ORDER BY gap, company_id) AS n FROM near)
    SELECT asked.label, asked.on_date, company_id, gap::BIGINT AS gap FROM asked LEFT JOIN best ON asked.label = best.label AND asked.on_date = best.on_date AND n = 1"""
)
def continuity_lookup(spark, sf):
    asked = w.table(spark, sf, "orders").select(F.concat(F.lit("L"), (F.col("o_custkey") % 3).cast("string")).alias("label"), F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("o_orderkey") % 30).cast("int")).alias("on_date")).distinct()
    removed = _moves(spark, sf).where("action = 'REMOVE'").select("company_id", "on_date")
    return entities.continuity(asked, _evidence(spark, sf), removed, 5)


@query(
    f"""WITH {_EVIDENCE}, iv AS (SELECT 'L' || i AS label, DATE '2024-01-01' + j::INTEGER AS start, CASE WHEN j % 2 = 0 THEN DATE '2024-01-03' + j::INTEGER END AS "end" FROM range(0, 4) a(i), range(0, 20, 5) b(j)),
    wt AS (SELECT *, CASE kind WHEN 'reference' THEN 0.8::DOUBLE WHEN 'add' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS w FROM ev),
    s AS (SELECT iv.label, iv.start, iv."end", company_id, round(sum(CASE WHEN on_date >= start - 2 AND ("end" IS NULL OR on_date <= "end" + 2) THEN w ELSE 0 END), 6) AS score FROM iv JOIN wt USING (label) GROUP BY ALL),
    t AS (SELECT label, start, "end", max(score) AS score, arg_max(company_id, score) AS company_id, count(*) AS n, list(score) AS all_ FROM s GROUP BY ALL),
    v AS (SELECT *, len(list_filter(all_, lambda x: x = score)) AS ties FROM t)
    SELECT iv.label, iv.start, iv."end", CASE WHEN (v.score > 0 AND ties = 1) OR (v.score = 0 AND n = 1) THEN company_id END AS company_id, v.score,
      coalesce(CASE WHEN v.score > 0 AND ties = 1 THEN 'ticker_evidence' WHEN v.score > 0 THEN 'ambiguous_tie' WHEN n = 1 THEN 'ticker_unique_no_dated_evidence' WHEN n > 1 THEN 'ambiguous_no_dated_evidence' END, 'no_candidate') AS rule
    FROM iv LEFT JOIN v ON iv.label = v.label AND iv.start = v.start AND iv."end" IS NOT DISTINCT FROM v."end" """
)
def evidence_scoring(spark, sf):
    i = spark.range(4).select(F.concat(F.lit("L"), F.col("id").cast("string")).alias("label"))
    j = spark.range(0, 20, 5).select(F.col("id").cast("int").alias("j"))
    iv = i.withColumn("j", F.explode(F.array(*[F.lit(x) for x in range(0, 20, 5)]))).select("label", F.date_add(F.to_date(F.lit("2024-01-01")), F.col("j")).alias("start"), F.when(F.col("j") % 2 == 0, F.date_add(F.to_date(F.lit("2024-01-03")), F.col("j"))).alias("end"))
    del j
    return entities.score_intervals(iv, _evidence(spark, sf), 2)


@query(
    """WITH RECURSIVE e AS (SELECT p_partkey AS node, p_partkey // 2 AS into_ FROM part WHERE p_partkey > 1), f AS (SELECT node, into_ AS root FROM e UNION ALL SELECT f.node, e.into_ FROM f JOIN e ON f.root = e.node)
    SELECT node, min(root) AS root FROM f GROUP BY node"""
)
def redirect_roots(spark, sf):
    parts = w.table(spark, sf, "part").where("p_partkey > 1").select(F.col("p_partkey").alias("node"), F.expr("p_partkey div 2").alias("into"))
    return entities.roots(parts)


@query("SELECT c_custkey AS company_id, 1::BIGINT AS tier FROM customer WHERE CAST(c_custkey AS VARCHAR) = '42'")
def find_company_by_id(spark, sf):
    c = w.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("label"), "c_custkey")
    return entities.find("42", c, c, c, "id").select(F.col("id").cast("long").alias("company_id"), "tier")


@query("SELECT c_custkey AS company_id, 3::BIGINT AS tier FROM customer WHERE lower(c_name) LIKE '%00007%'")
def find_company_by_name(spark, sf):
    c = w.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("label"))
    return entities.find("00007", c, c, c, "id").select(F.col("id").cast("long").alias("company_id"), "tier")


@query(
    f"""WITH {w.MEMBERS_CTE} SELECT company_id, company_name, count(*) AS n_memberships, string_agg(entry_date || '..' || coalesce(CAST(exit_date AS VARCHAR), ''), ';' ORDER BY entry_date) AS memberships,
    sum(coalesce(exit_date, DATE '{w.AS_OF}') - entry_date)::BIGINT AS days FROM members JOIN {w.NAMES_SQL} USING (company_id) GROUP BY company_id, company_name"""
)
def company_history(spark, sf):
    m = w.spells(spark, sf).withColumn("days", F.datediff(F.coalesce("exit_date", F.to_date(F.lit(w.AS_OF))), "entry_date"))
    each = F.concat(F.col("entry_date").cast("string"), F.lit(".."), F.coalesce(F.col("exit_date").cast("string"), F.lit("")))
    h = m.groupBy("company_id").agg(F.count("*").alias("n_memberships"), F.array_sort(F.collect_list(each)).alias("m"), F.sum("days").alias("days"))
    return h.join(w.names(spark, sf), "company_id").select("company_id", "company_name", "n_memberships", text.joined(F.col("m")).alias("memberships"), "days")


# -- claims from sources ----------------------------------------------------------------------------------------------


def _change_rows(spark, sf):
    o = w.table(spark, sf, "orders")
    reason = F.element_at(F.array(*map(F.lit, w.REASON_TEXTS)), (F.col("o_orderkey") % len(w.REASON_TEXTS) + 1).cast("int"))
    side = lambda k: F.when(F.col("o_orderkey") % k == 0, "").otherwise(F.concat(F.lit("T"), (F.col("o_custkey") % (90 + k)).cast("string")))
    return o.select(F.to_date("o_orderdate").alias("effective_date"), side(3).alias("added_ticker"), F.lit("A").alias("added_name"), side(4).alias("removed_ticker"), F.lit("R").alias("removed_name"), reason.alias("reason"), F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("http://x"))).alias("refs"), F.col("o_orderkey").cast("int").alias("row_index"))


_CHANGE_ROWS = f"""
rows_ AS (SELECT CAST(o_orderdate AS DATE) AS effective_date, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'T' || (o_custkey % 93) END AS a, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'T' || (o_custkey % 94) END AS r,
  {w._sql_reason().replace("event_id", "o_orderkey")} AS reason, CASE WHEN o_orderkey % 2 = 0 THEN 0.95::DOUBLE ELSE 0.9::DOUBLE END AS confidence, o_orderkey FROM orders),
cands AS (SELECT effective_date, 'ADD' AS action, a AS ticker, 'A' AS name, confidence, reason, r AS counterpart_ticker, 'changes table row ' || o_orderkey AS notes FROM rows_ WHERE a <> ''
  UNION ALL SELECT effective_date, 'REMOVE', r, 'R', confidence, reason, a, 'changes table row ' || o_orderkey FROM rows_ WHERE r <> '')"""


@query(f"WITH {_CHANGE_ROWS} SELECT *, {w.sql_classify('reason')} AS reason_category FROM cands")
def candidates_from_changes(spark, sf):
    return claims.from_changes(_change_rows(spark, sf)).drop("source_type", "refs")


@query(
    f"""WITH p AS ({_MONTHS}), n AS (SELECT d, row_number() OVER (ORDER BY d) AS k, lead(d) OVER (ORDER BY d) AS nxt FROM (SELECT DISTINCT d FROM p)),
    i AS (SELECT label, p.d, k, k - row_number() OVER (PARTITION BY label ORDER BY p.d) AS island FROM p JOIN n USING (d)), e AS (SELECT label, min(d) AS start, max(k) AS k FROM i GROUP BY label, island),
    s AS (SELECT CAST(label AS VARCHAR) AS ticker, start, nxt FROM e JOIN n USING (k))
    SELECT start AS effective_date, 'ADD' AS action, ticker, CASE WHEN start = (SELECT min(d) FROM p) THEN 0.5::DOUBLE ELSE 0.6::DOUBLE END AS confidence FROM s UNION ALL SELECT nxt, 'REMOVE', ticker, 0.6::DOUBLE FROM s WHERE nxt IS NOT NULL"""
)
def candidates_from_reference(spark, sf):
    lists = _months(spark, sf).groupBy("on_date").agg(F.collect_list(F.col("label").cast("string")).alias("tickers"))
    return claims.from_reference(lists).select("effective_date", "action", "ticker", "confidence")


@query(
    f"""WITH {_CHANGE_ROWS}, o AS (SELECT DISTINCT effective_date, action, ticker FROM cands WHERE ticker IN ('T5', 'T6'))
    SELECT effective_date, action, ticker, 'wikipedia_changes' AS source_type FROM cands c WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.effective_date = c.effective_date AND o.action = c.action AND o.ticker = c.ticker)
    UNION ALL SELECT DATE '1999-01-04', 'ADD', 'NEW', 'curated'"""
)
def candidate_overrides(spark, sf):
    c = claims.from_changes(_change_rows(spark, sf))
    drop = c.where(F.col("ticker").isin("T5", "T6")).select(F.lit("suppress").alias("mode"), F.col("effective_date").cast("string").alias("effective_date"), "action", "ticker", F.lit("").alias("company_name"), F.lit("").alias("reason"), F.lit("0").alias("confidence"), F.lit("").alias("note"))
    more = spark.sql("SELECT 'add' AS mode, '1999-01-04' AS effective_date, 'add' AS action, 'new' AS ticker, 'New' AS company_name, '' AS reason, '0' AS confidence, 'checked' AS note")
    return claims.apply_overrides(c, drop.union(more)).select("effective_date", "action", "ticker", "source_type")


# -- scalar functions -------------------------------------------------------------------------------------------------


@query("SELECT p_partkey, upper(regexp_replace(translate(replace(p_brand, '#', '-'), '-/', '..'), '\\s', '', 'g')) AS t, CASE WHEN regexp_matches(upper(translate(replace(p_brand, '#', '-'), '-/', '..')), '^[A-Z0-9]{1,6}(\\.[A-Z])?$') THEN upper(translate(replace(p_brand, '#', '-'), '-/', '..')) END AS ticker FROM part")
def normalize_ticker(spark, sf):
    p = w.table(spark, sf, "part").withColumn("b", F.translate("p_brand", "#", "-"))
    return p.select("p_partkey", F.upper(F.regexp_replace(F.translate("b", "-/", ".."), r"\s", "")).alias("t"), text.normalize_ticker(F.col("b")).alias("ticker"))


@query(
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE d END AS parsed FROM d"""
)
def parse_dates(spark, sf):
    d = F.to_date("o_orderdate")
    k = F.col("o_orderkey") % 4
    shown = F.when(k == 0, F.concat(F.date_format(d, "MMMM d, yyyy"), F.lit(" [ 2 ]"))).when(k == 1, F.date_format(d, "yyyy-MM-dd")).when(k == 2, F.concat(F.date_format(d, "M/d/yyyy"), F.lit(" (est.)"))).otherwise("sometime")
    return w.table(spark, sf, "orders").select("o_orderkey", text.parse_date(shown).alias("parsed"))


@query("SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9 ]+', ' ', 'g')) AS name_key FROM part")
def normalize_name_key(spark, sf):
    made = F.concat(F.lit("The "), F.col("p_name"), F.lit(" Holdings, Inc. (Class A) [1]"))
    return w.table(spark, sf, "part").select("p_partkey", text.normalize_name(made, ascii_only=True).alias("name_key"))


@query("SELECT conv_id, turn, trim(regexp_replace(regexp_replace(text, '\\[[^\\]]*\\]', '', 'g'), '[\\s\\x{a0}]+', ' ', 'g')) AS shown, CASE WHEN regexp_matches(role, '^[0-9]+$') THEN role END AS digits FROM conversations")
def clean_text(spark, sf):
    return w.table(spark, sf, "conversations").select("conv_id", "turn", text.strip_footnotes(F.col("text")).alias("shown"), text.digits_or_null(F.col("role")).alias("digits"))


@query("SELECT doc_id, source, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents) WHERE k = 1")
def latest_by_key(spark, sf):
    d = w.table(spark, sf, "documents").select("source", "doc_id", "n_chars")
    return analytics.latest_by(d, ["source"], "n_chars", "doc_id").select("doc_id", "source", "n_chars")


@query("SELECT page_id, list_count(regexp_extract_all(html, '<a href=\"[^\"]*\"')) AS n_links FROM pages")
def html_links(spark, sf):
    from ..sources.html import page_links

    return page_links(w.table(spark, sf, "pages"), "page_id", "html").groupBy("page_id").agg(F.count("href").alias("n_links"))


@query(
    """WITH a AS (SELECT s_suppkey AS entity, DATE '1990-01-01' + CAST(s_suppkey * 53 % 4000 AS INTEGER) AS first_seen FROM supplier),
    b AS (SELECT n_nationkey AS holder, DATE '1988-01-01' + CAST(n_nationkey * 90 AS INTEGER) AS start, DATE '1990-06-01' + CAST(n_nationkey * 170 AS INTEGER) AS b_first FROM nation),
    h AS (SELECT entity, holder, b_first - (first_seen + 100) AS gap FROM a JOIN b ON b_first - (first_seen + 100) BETWEEN 1 AND 431 AND start <= first_seen
          AND (holder % 4 = 0 OR start + CAST(holder % 4 * 900 AS INTEGER) >= first_seen + 100))
    SELECT 'S' || entity AS a, min('N' || holder) AS b, min(gap)::BIGINT AS gap FROM h GROUP BY entity HAVING count(*) = 1"""
)
def backfilled_rename(spark, sf):
    """Suppliers seen for a while only inside the interval of exactly one nation that is seen later."""
    at = lambda start, days: F.date_add(F.to_date(F.lit(start)), days.cast("int"))
    first = at("1990-01-01", F.col("s_suppkey") * 53 % 4000)
    hidden = w.table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey").cast("string")).alias("entity"), first.alias("first_seen"), F.date_add(first, 100).alias("last_seen"))
    n, holder = F.col("n_nationkey"), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("holder")
    nation, start = w.table(spark, sf, "nation"), at("1988-01-01", n * 90)
    spans = nation.select(holder, start.alias("start"), F.when(n % 4 != 0, F.date_add(start, (n % 4 * 900).cast("int"))).alias("end"))
    return entities.backfilled(hidden, spans, nation.select(holder, at("1990-06-01", n * 170).alias("first_seen")))


# -- lookups ----------------------------------------------------------------------------------------------------------


@query("SELECT c_custkey AS company_id, 2::BIGINT AS tier FROM customer WHERE c_mktsegment = 'BUILDING'")
def find_company_by_label(spark, sf):
    """A label, given in small letters, comes before names that hold it."""
    c = w.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("label"))
    return entities.find(" building ", c, c, c, "id").select(F.col("id").cast("long").alias("company_id"), "tier")


@query("SELECT s_suppkey, r_name AS canonical FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey AND s_suppkey % 5 <> 0 LEFT JOIN region ON n_regionkey = r_regionkey")
def alias_lookup(spark, sf):
    """Names in other letter case, with a legal form (every second) or unknown (every fifth) to the canonical name of an alias."""
    nation, region = w.table(spark, sf, "nation"), w.table(spark, sf, "region")
    known = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_name").alias("alias_name"), F.col("r_name").alias("canonical_name"), F.col("n_nationkey").alias("position"))
    form, unknown = F.when(F.col("s_suppkey") % 2 == 1, ", Inc.").otherwise(""), F.when(F.col("s_suppkey") % 5 == 0, "of elsewhere ").otherwise("")
    asked = w.table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.concat(unknown, F.lower("n_name"), form).alias("name"))
    return entities.alias_of(asked, known, "name", text.normalize_name(F.col("name")), text.normalize_name(F.col("alias_name"))).select("s_suppkey", "canonical")


@query(
    """WITH a AS (SELECT DISTINCT o_custkey % 50 AS l, CAST(o_orderdate AS DATE) AS on_date FROM orders), c AS (SELECT s_suppkey AS position, s_suppkey % 50 AS l, DATE '1995-01-01' + CAST(s_suppkey * 37 % 2400 AS INTEGER) AS d FROM supplier),
    h AS (SELECT a.l, on_date, c.d, position, row_number() OVER (PARTITION BY a.l, on_date ORDER BY position) AS nth FROM a JOIN c ON a.l = c.l AND abs(on_date - d) <= 45)
    SELECT 'N' || l AS label, on_date, 'O' || position AS old_ticker, d AS effective_date FROM h WHERE nth = 1"""
)
def curated_change_lookup(spark, sf):
    """The first listed change of a label within 45 days of each day on which it is asked for."""
    label = lambda c: F.concat(F.lit("N"), (F.col(c) % 50).cast("string"))
    asked = w.table(spark, sf, "orders").select(label("o_custkey").alias("label"), F.to_date("o_orderdate").alias("on_date"))
    day = F.date_add(F.to_date(F.lit("1995-01-01")), (F.col("s_suppkey") * 37 % 2400).cast("int"))
    changes = w.table(spark, sf, "supplier").select(F.concat(F.lit("O"), F.col("s_suppkey").cast("string")).alias("old_ticker"), label("s_suppkey").alias("new_ticker"), day.alias("effective_date"), F.col("s_suppkey").alias("position"))
    return entities.curated_change(asked, changes).select("label", "on_date", "old_ticker", "effective_date")


@query(
    """SELECT CAST(min(o_orderdate) AS DATE) AS effective_date, 'ADD' AS action, 'K' || c_custkey AS ticker, c_name AS name, 'wikipedia_constituents' AS source_type, 0.75::DOUBLE AS confidence
    FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey, c_name"""
)
def candidates_from_constituents(spark, sf):
    """An ADD for each row with a date of its own; customers without orders have none."""
    first = w.table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_date(F.min("o_orderdate")).alias("date_added"))
    rows = w.table(spark, sf, "customer").join(first, "c_custkey", "left").select(F.concat(F.lit("K"), F.col("c_custkey").cast("string")).alias("ticker"), F.col("c_name").alias("name"), "date_added")
    return claims.from_constituents(rows).select("effective_date", "action", "ticker", "name", "source_type", "confidence")


# -- builds -----------------------------------------------------------------------------------------------------------


def _built(spark, sf):
    claimed, sightings = w.build_inputs(spark, sf)
    return build(claimed, sightings, as_of=w.AS_OF)


@query(f"WITH {w.BUILD_CTE} SELECT company_name, entry_date, exit_date, entry_ticker, exit_ticker FROM labelled")
def build_intervals(spark, sf):
    """Identities, events and intervals of a whole build: the spells of the customers come back under their labels."""
    b = _built(spark, sf)
    named = b["companies"].select("company_id", F.col("canonical_name").alias("company_name"))
    gone = F.when(F.col("exit_date").isNotNull(), F.col("exit_ticker"))
    return b["intervals"].join(named, "company_id").select("company_name", "entry_date", "exit_date", "entry_ticker", gone.alias("exit_ticker"))


@query(
    f"""WITH {w.BUILD_CTE}
    SELECT company_name, entry_date AS effective_date, 'ADD' AS action, entry_ticker AS label FROM labelled
    UNION ALL SELECT company_name, exit_date, 'REMOVE', exit_ticker FROM labelled WHERE exit_date IS NOT NULL
    UNION ALL SELECT c_name, changed, 'TICKER_CHANGE', 'N' || company_id FROM moved"""
)
def build_events(spark, sf):
    """The events of a whole build, changes of labels among them."""
    b = _built(spark, sf)
    named = b["companies"].select("company_id", F.col("canonical_name").alias("company_name"))
    return b["events"].drop("name").join(named, "company_id").select("company_name", "effective_date", "action", "label")


@query(
    f"""WITH {w.BUILD_CTE}, t AS (SELECT DISTINCT company_id, company_name, changed FROM labelled)
    SELECT 'C' || substr(sha1(regexp_replace(lower(company_name), '[^a-z0-9]+', ' ', 'g')), 1, 10) AS company_id, company_name,
           CASE WHEN changed IS NULL THEN 1 ELSE 2 END AS n_labels, false AS needs_review FROM t"""
)
def build_companies(spark, sf):
    """The companies of a whole build with how many labels they have had."""
    b = _built(spark, sf)
    labels = b["tickers"].groupBy("company_id").agg(F.count_distinct("label").alias("n_labels"))
    return b["companies"].join(labels, "company_id").select("company_id", F.col("canonical_name").alias("company_name"), "n_labels", "needs_review")

"""The questions that a built membership answers, each a function of tables and a date, giving a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import CONTINUITY_DAYS
from ..functions.dates import quarter_ends
from ..functions.text import REASONS, compare_key
from ..operators import analytics, entities, reconcile, temporal
from ..sinks import artefacts

SECTOR_COLUMNS = "company_id string, ticker string, as_of_date date, gics_sector string, gics_sub_industry string, source_url string"


def iso(text: str) -> str:
    """A date in ISO form, or ValueError."""
    return date.fromisoformat(text).isoformat()


def day(text: str):
    return F.to_date(F.lit(iso(text)))


@dataclass
class Membership:
    """Tables of plans.build.build(), and sector observations."""

    companies: DataFrame
    names: DataFrame
    tickers: DataFrame
    events: DataFrame
    intervals: DataFrame
    issues: DataFrame
    sectors: DataFrame
    as_of: str
    discrepancies: DataFrame | None = None
    latest_run: DataFrame | None = None

    @classmethod
    def of(cls, built: dict[str, DataFrame], sectors: DataFrame | None = None, as_of: str = "2026-01-01") -> Membership:
        spark = built["events"].sparkSession
        return cls(built["companies"], built["names"], built["tickers"], built["events"], built["intervals"], built["issues"], sectors if sectors is not None else spark.createDataFrame([], SECTOR_COLUMNS), as_of)

    @classmethod
    def load(cls, spark: SparkSession, folder: str, as_of: str = "2026-01-01") -> Membership:
        """From the current version that sinks.artefacts.publish() wrote."""
        where = artefacts.current(spark, folder)
        t = lambda n: spark.read.parquet(f"{where}/{n}")
        known = artefacts.exists(spark, f"{where}/discrepancies")
        run = artefacts.latest_run(spark, folder).select("manifest_json") if artefacts.exists(spark, f"{folder}/build_runs") else None
        return cls(t("companies"), t("names"), t("tickers"), t("events"), t("intervals"), t("issues"), t("sectors"), as_of, t("discrepancies") if known else None, run)

    @property
    def shown(self) -> DataFrame:
        return self.companies.select("company_id", F.col("canonical_name").alias("company_name"))

    def _active(self, on: str, include_unsupported: bool) -> DataFrame:
        return self.intervals.where(temporal.active(F.col("entry_date"), F.col("exit_date"), day(on), None if include_unsupported else F.col("supported")))

    def tickers_as_of(self, on: str) -> DataFrame:
        return temporal.labels_as_of(self.tickers, day(on), label="label")

    def sector_as_of(self, on: str) -> DataFrame:
        return temporal.nearest_as_of(self.sectors, day(on), "company_id", "as_of_date", ["gics_sector", "gics_sub_industry", "source_url"])

    def constituents(self, on: str, include_unsupported: bool = False, with_sector: bool = True) -> DataFrame:
        """Members on a date with their labels, and their sectors as observed nearest to it."""
        m = self._active(on, include_unsupported).join(self.shown, "company_id").join(self.tickers_as_of(on), "company_id", "left")
        m = m.withColumn("tickers", F.coalesce("tickers", F.array("entry_ticker")))
        if with_sector:
            m = m.join(self.sector_as_of(on).withColumnRenamed("as_of_date", "sector_as_of").withColumnRenamed("source_url", "sector_source"), "company_id", "left")
        else:
            m = m.withColumns({c: F.lit(None).cast(t) for c, t in (("gics_sector", "string"), ("gics_sub_industry", "string"), ("sector_as_of", "date"), ("sector_source", "string"))})
        return m.select("company_id", "company_name", "tickers", "entry_date", "exit_date", "left_censored", "supported", "gics_sector", "gics_sub_industry", "sector_as_of", "sector_source").orderBy(F.element_at("tickers", 1), "company_id")

    def changes(self, start: str, end: str, actions: list[str] | None = None, min_confidence: float = 0.0) -> DataFrame:
        return temporal.changes_in_range(self.events, iso(start), iso(end), actions, min_confidence).orderBy("effective_date", "action", "label", "event_id")

    def shaped(self, events: DataFrame) -> DataFrame:
        """Events with the 17 fields that are shown; what the claims don't carry is null."""
        named = {"ticker_at_event": "label", "company_name": "name"}
        text = ("event_id", "effective_date", "action", "company_id", "ticker_at_event", "company_name", "reason", "reason_category", "counterpart_company_id", "source_url", "source_type", "scraped_at", "raw_sha256", "confidence", "corroborating_sources", "refs", "notes")
        return events.select(*[(F.col(named.get(c, c)) if named.get(c, c) in events.columns else F.lit(None).cast("string")).alias(c) for c in text])

    def find(self, query: str) -> DataFrame:
        known = self.names.select("company_id", "name").union(self.companies.select("company_id", F.col("canonical_name").alias("name")))
        return entities.find(query, self.companies, self.tickers, known).join(self.companies, "company_id").orderBy("company_id")

    def history(self, query: str) -> DataFrame:
        """A row per company found, with all that is known of it as nested lists."""
        found = self.find(query).select("company_id", "canonical_name", "cik", "needs_review", "notes")
        if not found.limit(1).count():
            raise LookupError(f"no company matches {query!r}")

        def lists(df: DataFrame, name: str, *columns) -> DataFrame:
            return df.groupBy("company_id").agg(F.array_sort(F.collect_list(F.struct(*columns))).alias(name))

        length = F.datediff(F.coalesce("exit_date", day(self.as_of)), F.coalesce("entry_date", day("1996-01-02"))).alias("days")
        parts = (
            lists(self.names, "names", "first_seen", "name"), lists(self.tickers, "tickers", "valid_from", "valid_to", "label"),
            lists(self.intervals, "memberships", "entry_date", "exit_date", "entry_ticker", "exit_ticker", "exit_reason_category", "left_censored", "supported", length),
            lists(self.events, "events", "effective_date", "action", "event_id", "label", "reason", "reason_category", "confidence"), lists(self.sectors, "sectors", "as_of_date", "gics_sector", "gics_sub_industry", "source_url"),
        )
        for p in parts:
            found = found.join(p, "company_id", "left")
        return found

    def longest(self, limit: int = 25, as_of: str | None = None, current_only: bool = False) -> DataFrame:
        return analytics.longest(self.intervals, self.shown, iso(as_of or self.as_of), limit, current_only)

    def exits(self, start: str, end: str, category: str | None = None) -> DataFrame:
        return analytics.exited(self.intervals, self.shown, self.events, iso(start), iso(end), category).orderBy("exit_date", "company_id")

    def turnover(self, start_year: int = 2001, end_year: int | None = None) -> DataFrame:
        return analytics.turnover(self.events, self.intervals.where("supported"), start_year, self.as_of, end_year).orderBy("year")

    def exit_reasons(self, start_year: int = 2001) -> DataFrame:
        return analytics.pivot_by_year(self.events, "reason_category", list(REASONS), start_year).orderBy("year")

    def sector_composition(self, on: str) -> DataFrame:
        return analytics.composition(self.constituents(on), "gics_sector").orderBy(F.col("count").desc(), "gics_sector")

    def durations(self) -> tuple[DataFrame, DataFrame]:
        return analytics.duration_stats(self.intervals, self.as_of), analytics.duration_histogram(self.intervals).orderBy("bin")

    def survival(self, cohort_start: str, cohort_end: str, horizon_years: float = 25) -> DataFrame:
        return analytics.survival(self.intervals, iso(cohort_start), iso(cohort_end), self.as_of, horizon_years).orderBy("years")

    def cemetery(self, limit: int = 2000) -> DataFrame:
        return analytics.cemetery(self.intervals, self.shown, limit)

    def quality(self) -> tuple[DataFrame, int]:
        """Issues by kind, and how many companies are to be reviewed."""
        return analytics.issue_counts(self.issues).orderBy("kind"), self.companies.where("needs_review").count()

    def discrepancy_counts(self) -> DataFrame:
        """Ranges of disagreement by comparison, severity and kind; none where the build compared nothing."""
        if self.discrepancies is None:
            return self.events.sparkSession.createDataFrame([], "comparison string, severity string, kind string, n long")
        return analytics.discrepancy_counts(self.discrepancies).orderBy("comparison", "severity", "kind")


def sector_observations(rows: DataFrame, built: dict[str, DataFrame]) -> DataFrame:
    """Page rows (on_date, ticker, gics_sector, gics_sub_industry, source_url) with the company that held the label then."""
    asked = rows.where(F.col("gics_sector").isNotNull() | F.col("gics_sub_industry").isNotNull())
    held = entities.continuity(asked.select(F.col("ticker").alias("label"), "on_date").distinct(), built["evidence"], built["moves"].where("action = 'REMOVE'"), CONTINUITY_DAYS)
    named = asked.withColumnRenamed("ticker", "label").join(held.where(F.col("company_id").isNotNull()).drop("gap"), ["label", "on_date"])
    return named.select("company_id", F.col("label").alias("ticker"), F.col("on_date").alias("as_of_date"), "gics_sector", "gics_sub_industry", "source_url")


def name_unknown(built: dict[str, DataFrame], rows: DataFrame) -> DataFrame:
    """companies, those known by label only named after the first dated page row of that label within 400 days."""
    unknown = built["companies"].where("needs_review").select("company_id")
    seen = built["evidence"].join(unknown, "company_id", "left_semi").select("company_id", "label", F.col("on_date").alias("seen"))
    near = temporal.band_join(seen.withColumnRenamed("seen", "on_date"), rows.select(F.col("ticker").alias("label"), F.col("on_date").alias("shown"), "name"), ["label"], "on_date", "shown", CONTINUITY_DAYS)
    first = near.groupBy("company_id").agg(F.min(F.struct("shown", "name"))["name"].alias("_name"))
    return built["companies"].join(first, "company_id", "left").withColumn("canonical_name", F.coalesce("_name", "canonical_name")).drop("_name")


def reconciliation(m: Membership, built: dict[str, DataFrame], start: str, end: str, pages: DataFrame | None = None) -> dict[str, DataFrame]:
    """Company by company against the reference on each day that it changed and each quarter's end; label by label
    against dated pages (on_date, ticker). Gives `ranges` and `per_date`."""
    spark = m.events.sparkSession
    theirs = built["assigned"].select("company_id", F.col("label").alias("ticker"), F.col("start").alias("entry_date"), F.col("end").alias("exit_date"))
    moved = theirs.select(F.col("entry_date").alias("on_date")).union(theirs.select("exit_date")).where(F.col("on_date").between(day(start), day(end)))
    dates = moved.union(quarter_ends(spark, iso(start), iso(end))).distinct()
    ours = temporal.stab(dates, m.intervals.where("supported")).select("on_date", "company_id")
    other = temporal.stab(dates, theirs).select("on_date", "company_id")
    found = reconcile.differences(ours, other, ["on_date", "company_id"], "reference_company").withColumn("ticker", F.lit(""))
    if pages is not None:
        on = pages.select("on_date").distinct()
        held = temporal.stab(on, m.intervals.where("supported")).select("on_date", "company_id", "entry_ticker")
        spans = m.tickers.select("company_id", "label", "valid_from", "valid_to")
        labelled = held.join(spans, "company_id", "left").where(F.col("label").isNull() | temporal.valid(F.col("valid_from"), F.col("valid_to"), F.col("on_date")))
        mine = labelled.select("on_date", compare_key(F.coalesce("label", "entry_ticker")).alias("ticker"))
        shown = pages.select("on_date", compare_key(F.col("ticker")).alias("ticker"))
        labels = reconcile.differences(mine, shown, ["on_date", "ticker"], "page_ticker")
        owner = reconcile.unique_owner(m.tickers, "label", "company_id", compare_key(F.col("label")))
        found = found.unionByName(labels.join(owner, labels["ticker"] == owner["tkey"], "left").select("on_date", F.coalesce("company_id", F.lit("")).alias("company_id"), "comparison", "kind", "ticker"))
    ranges = reconcile.collapse(found, ["ticker", "company_id"], "on_date").join(m.shown, "company_id", "left")
    return {"ranges": ranges.orderBy("comparison", "severity", "first_date", "ticker", "company_id"), "per_date": reconcile.tallies(ours, other, "on_date", ["company_id"]).orderBy("on_date")}

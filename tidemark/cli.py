"""Command line: scrape bodies, build artefacts, load them as tables, ask or serve them."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import CHANGES, DATE_ADDED, REFERENCE, REVISION, REVISION_LOOKUP, Settings
from .functions.dates import new_years
from .operators import claims
from .operators.reconcile import render_report
from .plans import routes
from .plans.api import Membership, name_unknown, reconciliation, sector_observations
from .plans.build import build
from .sinks import artefacts
from .sources import html, rawstore, tables

#: Tables of a build, in the order in which they are loaded.
TABLES = ("companies", "names", "tickers", "events", "intervals", "issues", "sectors", "discrepancies", "per_date")


def run_scrape(spark: SparkSession, settings: Settings, force: bool = False) -> int:
    """Fetches what sources.csv lists, then the revision of each new year if it lists how; gives the number of bodies."""
    fetcher = rawstore.Fetcher(settings.raw_dir, settings.requests_per_second, settings.timeout_s, settings.attempts)
    listed = tables.addresses(spark, settings.curated_dir)
    by_source = dict(listed)
    plain = [(source, url) for source, url in listed if source not in (REVISION, REVISION_LOOKUP)]
    for source, url in plain:
        fetcher.fetch(source, url, force=force, ext="csv" if url.endswith(".csv") else "html")
    dated = []
    if REVISION in by_source and REVISION_LOOKUP in by_source:
        years = new_years(spark, int(settings.window_start[:4]), int(settings.window_end[:4])).where(F.col("on_date") <= F.current_date())
        dated = rawstore.fetch_revisions(fetcher, [str(r["on_date"]) for r in years.collect()], REVISION_LOOKUP, by_source[REVISION_LOOKUP], REVISION, by_source[REVISION])
    return len(plain) + len(dated)


def run_build(spark: SparkSession, settings: Settings, as_of: str, reference: bool = True) -> dict:
    """From the raw store and the curated hints to the artefacts in build_dir: tables, CSVs, decision log, problems,
    candidates, report and manifest, which is also returned."""
    raw, out = settings.raw_dir, settings.build_dir
    body = lambda source, part=None: rawstore.bodies(spark, raw, rawstore.latest(spark, raw, source, part))
    changes_page, today_page = html.parse_changes(body(CHANGES), "url", "text"), html.parse_constituents(body(DATE_ADDED), "url", "text")
    changed = changes_page.select(F.explode("rows").alias("r")).select("r.*")
    today = today_page.select(F.to_date(F.lit(as_of)).alias("on_date"), F.col("url").alias("source_url"), F.explode("rows").alias("r")).select("on_date", "source_url", "r.*")
    dated = rawstore.bodies(spark, raw, rawstore.revisions(spark, raw, REVISION)) if artefacts.exists(spark, f"{raw}/{REVISION}/manifest.jsonl") else None
    rows, past, problems = today.withColumn("kind", F.lit("current")), None, problems_of(changes_page, CHANGES).union(problems_of(today_page, DATE_ADDED))
    if dated is not None:
        listed = html.parse_constituents(dated.withColumn("key", F.concat_ws("|", F.col("on_date").cast("string"), "url")), "key", "text")
        past = listed.select(F.to_date(F.substring_index("key", "|", 1)).alias("on_date"), F.substring_index("key", "|", -1).alias("source_url"), F.explode("rows").alias("r")).select("on_date", "source_url", "r.*")
        rows = past.withColumn("kind", F.lit("snapshot")).unionByName(rows)
        problems = problems.union(problems_of(listed, REVISION))
    hints = tables.curated(spark, settings.curated_dir)
    snapshots = None
    if reference:
        path = rawstore.latest(spark, raw, REFERENCE, "Historical").first()["path"]
        snapshots = tables.membership_list(spark, f"{raw}/{path}")
    built = build(claims.from_changes(changed).unionByName(claims.from_constituents(today)), rows.select("on_date", "ticker", "name", "cik", "kind"), snapshots, hints, as_of, settings)
    built["companies"] = name_unknown(built, rows)
    built["sectors"] = sector_observations(rows, built)
    m = Membership.of(built, built["sectors"], as_of)
    found = reconciliation(m, built, settings.window_start, min(settings.window_end, as_of), past)
    built |= {"discrepancies": found["ranges"], "per_date": found["per_date"]}
    kept = artefacts.publish({k: built[k] for k in TABLES}, out)
    t = {k: spark.read.parquet(f"{kept}/{k}") for k in TABLES}
    for k in TABLES:
        artefacts.write_csv(m.shaped(t[k]) if k == "events" else t[k], f"{out}/csv/{k}")
    artefacts.write_csv(problems, f"{out}/csv/parse_problems")
    artefacts.write_csv(built["resolved"].drop("claim_id", "label", "rank"), f"{out}/csv/candidates")
    artefacts.write_log(built["log"], f"{out}/resolution_log", mode="overwrite")
    unknown = t["companies"].where("needs_review").select("company_id", "canonical_name")
    manifest = {
        "built_at": as_of, "window": [settings.window_start, settings.window_end],
        "n_companies": t["companies"].count(), "n_events": t["events"].count(), "n_intervals": t["intervals"].count(), "n_unsupported_intervals": t["intervals"].where("NOT supported").count(),
        "n_issues": t["issues"].count(), "n_discrepancy_ranges": t["discrepancies"].count(), "n_unknown_companies": unknown.count(), "n_parse_problems": problems.count(),
    }
    artefacts.write_text(spark, f"{out}/reconciliation/report.md", render_report(t["discrepancies"], t["per_date"], t["issues"], unknown, manifest))
    artefacts.write_text(spark, f"{out}/build_manifest.json", json.dumps(manifest, indent=2) + "\n")
    return manifest


def problems_of(pages: DataFrame, source: str) -> DataFrame:
    """(source, where, row, error) of the rows that a parser refused."""
    return pages.select(F.explode("problems").alias("p")).select(F.lit(source).alias("source"), "p.where", F.array_join("p.row", " | ", "").alias("row"), "p.error")


def run_load(spark: SparkSession, settings: Settings) -> dict[str, int]:
    """The latest build as the store's current version, and a row of the run history; gives the rows of each table.
    A load that fails leaves the version before, as a whole."""
    where = artefacts.current(spark, settings.build_dir)
    loaded = {k: spark.read.parquet(f"{where}/{k}") for k in TABLES}
    kept = artefacts.publish(loaded, settings.store_dir)
    manifest = json.loads(artefacts.read_text(spark, f"{settings.build_dir}/build_manifest.json"))
    artefacts.append_run(spark, settings.store_dir, manifest)
    return {k: spark.read.parquet(f"{kept}/{k}").count() for k in TABLES}


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("--raw", default=Settings.raw_dir)
    p.add_argument("--curated", default=Settings.curated_dir)
    p.add_argument("--out", default=Settings.build_dir)
    p.add_argument("--store", default=Settings.store_dir)
    p.add_argument("--as-of", required=True)
    sub = p.add_subparsers(dest="verb", required=True)
    sub.add_parser("scrape").add_argument("--force", action="store_true")
    fetch = sub.add_parser("fetch")
    fetch.add_argument("source", choices=sorted(tables.SOURCES))
    fetch.add_argument("url")
    sub.add_parser("build").add_argument("--no-reference", action="store_true")
    sub.add_parser("load")
    sub.add_parser("all").add_argument("--force", action="store_true")
    serve = sub.add_parser("serve")
    serve.add_argument("--host", default="127.0.0.1")
    serve.add_argument("--port", type=int, default=8000)
    ask = sub.add_parser("members")
    ask.add_argument("on")
    a = p.parse_args(argv)
    settings = Settings(a.raw, a.curated, a.out, a.store)
    if a.verb == "fetch":
        rawstore.Fetcher(settings.raw_dir, settings.requests_per_second, settings.timeout_s, settings.attempts).fetch(a.source, a.url)
        return
    spark = SparkSession.builder.appName("tidemark").getOrCreate()
    if a.verb in ("scrape", "all"):
        print(f"bodies: {run_scrape(spark, settings, a.force)}")
    if a.verb in ("build", "all"):
        print(json.dumps(run_build(spark, settings, a.as_of, not getattr(a, "no_reference", False))))
    if a.verb in ("load", "all"):
        for table, n in run_load(spark, settings).items():
            print(f"{table:20s} {n}")
    if a.verb == "serve":
        routes.server(lambda: Membership.load(spark, settings.store_dir, a.as_of), a.host, a.port).serve_forever()
    if a.verb == "members":
        for row in artefacts.to_json(Membership.load(spark, settings.store_dir, a.as_of).constituents(a.on)).toLocalIterator():
            print(row["json"])


if __name__ == "__main__":
    main()

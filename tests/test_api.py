"""The questions, on one small world from claims to answers."""

import pytest
from pyspark.sql import functions as F

from tests.test_build import D, claim, world
from tidemark.operators import reconcile
from tidemark.plans import routes
from tidemark.plans.api import Membership, name_unknown, reconciliation, sector_observations
from tidemark.sinks import artefacts


@pytest.fixture(scope="module")
def built(spark):
    reason = "Beta acquired Alpha."
    rows = [
        claim("ADD", "2005-01-03", "AAA", "Alpha Inc"), claim("REMOVE", "2010-06-01", "AAA", "Alpha Inc", reason, "BBB"), claim("ADD", "2010-06-01", "BBB", "Beta Corp", reason, "AAA"),
        claim("ADD", "2001-01-02", "CCC", "Gamma", source="wikipedia_constituents", confidence=0.75),
    ]
    snaps = {"2008-01-01": [("AAA", "Alpha Inc"), ("CCC", "Gamma")], "2012-01-01": [("BBB", "Beta Corp"), ("CCC", "Gamma")]}
    return world(spark, rows, snaps, {"1996-01-02": "CCC", "2005-01-03": "CCC,AAA", "2010-06-01": "CCC,BBB"})


@pytest.fixture(scope="module")
def m(spark, built, tmp_path_factory):
    pages = spark.createDataFrame([(D("2008-01-01"), "AAA", "Industrials", "Machines", "u")], "on_date date, ticker string, gics_sector string, gics_sub_industry string, source_url string")
    built["sectors"] = sector_observations(pages, built)
    folder = str(tmp_path_factory.mktemp("db"))
    artefacts.publish({k: built[k] for k in ("companies", "names", "tickers", "events", "intervals", "issues", "sectors")}, folder)
    return Membership.load(spark, folder)


def labels(df):
    return [r["tickers"][0] for r in df.collect()]


def test_constituents(m):
    out = {r["tickers"][0]: r for r in m.constituents("2007-01-01").collect()}
    assert set(out) == {"AAA", "CCC"} and out["AAA"]["gics_sector"] == "Industrials" and out["CCC"]["gics_sector"] is None
    assert labels(m.constituents("2011-01-01")) == ["BBB", "CCC"] and labels(m.constituents("2010-06-01", with_sector=False)) == ["BBB", "CCC"]
    with pytest.raises(ValueError):
        m.constituents("not a date")


def test_changes_and_exits(m):
    assert {(r["action"], r["label"]) for r in m.changes("2010-01-01", "2010-12-31").collect()} == {("REMOVE", "AAA"), ("ADD", "BBB")}
    (gone,) = m.exits("2010-01-01", "2010-12-31").collect()
    assert gone["exit_ticker"] == "AAA" and gone["exit_reason_category"] == "acquisition" and gone["reason"] == "Beta acquired Alpha."
    assert m.cemetery().first()["company_name"] == "Alpha Inc"


def test_find_and_history(m):
    assert m.find("aaa").first()["canonical_name"] == "Alpha Inc" and m.find("gam").first()["canonical_name"] == "Gamma"
    h = m.history("AAA").first()
    assert len(h["memberships"]) == 1 and [e["action"] for e in h["events"]] == ["ADD", "REMOVE"] and h["sectors"][0]["gics_sector"] == "Industrials"
    with pytest.raises(LookupError):
        m.history("nobody at all")


def test_analytics(m):
    assert m.longest(1).first()["company_name"] == "Gamma"
    year = {r["year"]: r for r in m.turnover(2009, 2011).collect()}
    assert year[2010]["removals"] == 1 and year[2010]["members_at_year_end"] == 2 and year[2010]["turnover_pct"] == 50.0 and year[2009]["additions"] == 0
    assert m.exit_reasons().where("year = 2010").first()["acquisition"] == 1
    assert m.sector_composition("2007-01-01").count() == 2
    stats, histogram = m.durations()
    assert stats.first()["n_completed"] == 1 and histogram.first()["label"] == "5-10y"
    curve = m.survival("2001-01-01", "2026-01-01").collect()
    assert curve[0]["survival"] == 1.0 and curve[-1]["survival"] == 0.5
    issues, review = m.quality()
    assert review == 0 and issues.count() >= 0


def test_reconciliation(spark, m, built):
    out = reconciliation(m, built, "2001-01-01", "2012-12-31", spark.createDataFrame([(D("2012-01-01"), "BBB"), (D("2012-01-01"), "ZZZ"), (D("2012-01-01"), "C.CC")], "on_date date, ticker string"))
    assert out["per_date"].where("missing > 0 OR extra > 0").count() == 0
    assert [(r["kind"], r["ticker"]) for r in out["ranges"].collect()] == [("missing_in_ours", "ZZZ")]
    text = reconcile.render_report(out["ranges"], out["per_date"], m.issues, m.companies.where("needs_review").select("company_id"), {"built_at": "x"})
    assert "ZZZ" in text and "## Dates" in text
    assert name_unknown(built, spark.createDataFrame([(D("2012-01-01"), "BBB", "B")], "on_date date, ticker string, name string")).count() == built["companies"].count()
    assert F is not None


def test_routes(m):
    get = lambda target: routes.answer(m, target)
    status, body = get("/constituents?date=2007-01-01")
    assert status == 200 and body["count"] == 2 and {r["tickers"][0] for r in body["constituents"]} == {"AAA", "CCC"}
    assert next(r for r in body["constituents"] if r["tickers"] == ["CCC"])["gics_sector"] is None
    status, body = get("/changes?start_date=2010-01-01&end_date=2010-12-31&action=REMOVE")
    assert status == 200 and [r["ticker_at_event"] for r in body["changes"]] == ["AAA"] and len(body["changes"][0]) == 17
    assert get("/companies/aaa")[1]["companies"][0]["canonical_name"] == "Alpha Inc"
    assert get("/companies/nobody%20at%20all")[0] == 404 and get("/nowhere")[0] == 404
    assert get("/constituents?date=07/01/2007")[0] == 400 and get("/constituents")[0] == 422 and get("/memberships/longest?limit=x")[0] == 422
    assert get("/memberships/longest?limit=1")[1]["memberships"][0]["company_name"] == "Gamma"
    assert get("/exits?start_date=2010-01-01&end_date=2010-12-31&reason_category=acquisition")[1]["count"] == 1
    assert get("/analytics/turnover?start_year=2010&end_year=2010")[1]["turnover"][0]["removals"] == 1
    assert any(r["year"] == 2010 for r in get("/analytics/exit-reasons")[1]["exit_reasons"])
    assert get("/analytics/sectors?date=2007-01-01")[1]["date"] == "2007-01-01"
    assert get("/analytics/duration")[1]["histogram"][0]["label"] == "5-10y"
    assert get("/analytics/survival")[1]["curve"][0]["survival"] == 1.0
    assert get("/cemetery")[1]["companies"][0]["company_name"] == "Alpha Inc"
    assert get("/quality")[1]["companies_needing_review"] == 0 and get("/health")[1]["status"] == "ok"
    assert len(get("/")[1]["routes"]) == 14

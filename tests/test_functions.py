import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import dates, ids, text


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r["o"] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").collect()]


def test_dates(spark):
    assert column(spark, ["August 18, 2026 [ 2 ]", "2013-06-21", "Dec 2, 2013", "sometime in 2013", None, "3/4/2010", "2 May 2001", "May 2001", "June 1, 2020 (est.)"], text.parse_date) == [
        dt.date(2026, 8, 18), dt.date(2013, 6, 21), dt.date(2013, 12, 2), None, None, dt.date(2010, 3, 4), dt.date(2001, 5, 2), dt.date(2001, 5, 1), dt.date(2020, 6, 1),
    ]


def test_tickers(spark):
    assert column(spark, ["BRK-B", "ALLE |", "", "not a ticker!", "bf/b", None], text.normalize_ticker) == ["BRK.B", "ALLE", "", None, "BF.B", ""]
    assert column(spark, ["BRK.B", "a-b"], text.compare_key) == ["BRKB", "AB"]


def test_names(spark):
    values = ["The Walt Disney Company", "Alphabet Inc. (Class A)", "Société Générale S.A.", "AT&T Corporation", "Procter & Gamble Co. and Co", "Inc", "", "Hewlett Packard Holdings, Ltd. and"]
    assert column(spark, values, text.normalize_name) == ["walt disney", "alphabet", "societe generale s a", "at and t", "procter and gamble", "", "", "hewlett packard"]
    assert column(spark, ["The Company", "the " * 9 + "Inc", "l inc p", "Ñandú Co", None], text.normalize_name) == ["", "the", "", "nandu", ""]
    again = column(spark, ["the the inc corp and the co walt and"], text.normalize_name)
    assert column(spark, again, text.normalize_name) == again
    assert column(spark, ["Chubb[a] Limited [ 12 ]"], text.clean_display_name) == ["Chubb Limited"]


def test_reasons(spark):
    values = ["Ticker symbol changed from FB to META.", "Beta acquired Alpha.", "spun off from X", "Filed for Chapter 11", "", None, "weather", "Taken private by a fund", "moved to the S&P MidCap 400", "Market capitalization change"]
    assert column(spark, values, text.classify_reason) == ["ticker_or_name_change", "acquisition", "spinoff", "bankruptcy", "other_unknown", "other_unknown", "other_unknown", "going_private", "index_rebalancing_reclassification", "market_cap_eligibility"]


def test_ids_and_lists(spark):
    r = spark.range(1).select(ids.company_id(F.lit("walt disney")).alias("c"), ids.event_id(F.lit("C1"), F.to_date(F.lit("2020-01-02")), F.lit("ADD"), F.lit("X")).alias("e"), text.split_list(F.lit("a;b")).alias("l"), text.split_list(F.lit(None)).alias("n")).first()
    assert len(r["c"]) == 11 and r["c"][0] == "C" and len(r["e"]) == 15 and r["l"] == ["a", "b"] and r["n"] == []


def test_calendars(spark):
    assert [r[0] for r in dates.quarter_ends(spark, "2001-01-01", "2001-12-31").orderBy("on_date").collect()] == [dt.date(2001, 3, 31), dt.date(2001, 6, 30), dt.date(2001, 9, 30), dt.date(2001, 12, 31)]
    assert dt.date(2007, 7, 1) in [r[0] for r in dates.new_years(spark, 2006, 2008).collect()]

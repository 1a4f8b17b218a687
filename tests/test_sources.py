import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import artefacts
from tidemark.sources import html, rawstore, tables

def page(table_id, header, rows, after=""):
    """A page of one table; cells are texts or HTML, rows of pairs have attributes."""
    cell = lambda c: f"<td {c[1]}>{c[0]}</td>" if isinstance(c, tuple) else f"<td>{c}</td>"
    return f"<h1>x</h1><table id='{table_id}'><tr>" + "".join(f"<th>{h}</th>" for h in header) + "</tr>" + "".join("<tr>" + "".join(map(cell, r)) + "</tr>" for r in rows) + "</table>" + after


NOTES = "<ul><li id='cite_note-q'><a href='http://example.net/q'>q</a> <a href='/local'>l</a></li></ul>"
CHANGES = page(
    "changes", ["When", "In", "Name", "Out", "Name", "Why"],
    [
        ["3 March 1999", "ORB", "Orbit[b]", "KELP", "Kelp Farms", "Orbit bought Kelp.", "<a href='#cite_note-q'>q</a><a href='#other'>o</a>"],
        ["1999-05-06", "", "", "moss/a", "Moss", "left"],
        ["1999-05-06", "", "", "", "", "nothing"],
        ["the ides", "FERN", "Fern", "", "", ""],
        ["1999-05-07", "FERN", "Fern", "", "", ("", "rowspan=2")],
        ["1999-05-08", "FERN"],
        ["1999-05-09", "not a label!", "", "", "", ""],
    ], NOTES,
)


def test_changes(spark):
    pages = spark.createDataFrame([(1, CHANGES), (2, "<p>nothing</p>"), (3, None)], "page_id long, html string")
    out = {r["page_id"]: r for r in html.parse_changes(pages, "page_id", "html").collect()}
    assert [(str(r["effective_date"]), r["added_ticker"], r["added_name"], r["removed_ticker"], r["refs"], r["row_index"]) for r in out[1]["rows"]] == [
        ("1999-03-03", "ORB", "Orbit", "KELP", ["http://example.net/q"], 1), ("1999-05-06", "", "", "MOSS.A", [], 2)]
    assert [p["row"][0] for p in out[1]["problems"]] == ["1999-05-06", "the ides", "1999-05-07", "1999-05-08", "1999-05-09"]
    assert out[2]["problems"][0]["where"] == "page" and out[3]["rows"] == []
    assert html.changes(CHANGES, resolve=False)[0][0]["refs"] == ["#cite_note-q"]
    unnamed = CHANGES.replace("id='changes'", "").replace("<th>When</th>", "<td>Effective date of it</td>")
    assert len(html.changes(unnamed)[0]) == 2


def test_members(spark):
    header = ["Company", "Ticker", "Sector", "Sub industry", "Address", "Date first added", "CIK", "Founded"]
    rows = [["<a href='/wiki/Orb'>Orbit</a>", "orb-x", "Space", "", "Mars", "May 4, 1998", "0000000042", "1901"], ["Kelp", "KELP", "", "Sea", "", "long ago", "none", ""], ["Nameless", "", "", "", "", "", "", ""], [""] * 8]
    one = spark.createDataFrame([(1, page("constituents", header, rows))], "page_id long, html string")
    m = html.parse_constituents(one, "page_id", "html").first()
    first, second = m["rows"]
    assert (first["ticker"], first["name"], first["date_added"], first["cik"], first["href"], first["headquarters"]) == ("ORB.X", "Orbit", dt.date(1998, 5, 4), "0000000042", "/wiki/Orb", "Mars")
    assert (second["date_added"], second["date_added_raw"], second["cik"], second["gics_sector"], second["gics_sub_industry"], second["href"]) == (None, "long ago", None, None, "Sea", None)
    assert len(m["problems"]) == 1
    many, _ = html.constituents(page("", ["Name", "Symbol"], [[f"N{i}", f"T{i}"] for i in range(99)]))
    assert len(many) == 99 and many[98]["ticker"] == "T98"
    assert html.column_meanings(["Ticker", "Secrity", "Sector"]) == {"ticker": 0, "name": 1, "sector": 2}
    for bad in ("<p></p>", page("constituents", ["Name", "Sector"], []), page("", ["Name", "Symbol"], [["N", "T"]] * 98)):
        with pytest.raises(ValueError):
            html.constituents(bad)


def test_raw_store(spark, tmp_path):
    raw = str(tmp_path)
    at = dt.datetime(2020, 1, 1, tzinfo=dt.timezone.utc)
    a = rawstore.put(raw, "s", "http://x/1", b"one", at=at, note="snapshot for 2019-01-01")
    b = rawstore.put(raw, "s", "http://x/1", b"one", at=at + dt.timedelta(days=1), note="snapshot for 2019-01-01")
    c = rawstore.put(raw, "s", "http://x/2", b"two", at=at + dt.timedelta(days=2))
    assert a["path"] == b["path"] != c["path"]
    assert rawstore.manifest(spark, raw, "s").count() == 3
    assert rawstore.latest(spark, raw, "s").first()["url"] == "http://x/2"
    assert rawstore.latest(spark, raw, "s", "x/1").first()["fetched_at"] == "2020-01-02T00:00:00Z"
    with pytest.raises(FileNotFoundError):
        rawstore.latest(spark, raw, "s", "nothing")
    assert [r["on_date"] for r in rawstore.revisions(spark, raw, "s").collect()] == [dt.date(2019, 1, 1)]
    assert {r["text"] for r in rawstore.bodies(spark, raw, rawstore.latest_per_url(spark, raw, "s")).collect()} == {"one", "two"}
    (tmp_path / c["path"]).write_bytes(b"changed")
    with pytest.raises(Exception, match="sha256 mismatch"):
        rawstore.bodies(spark, raw, rawstore.latest(spark, raw, "s")).collect()
    revid, when = rawstore.revision_of(F.lit('{"revid": 12, "timestamp": "2001-01-01T00:00:00Z"}'))
    assert tuple(spark.range(1).select(revid, when).first()) == (12, "2001-01-01T00:00:00Z")


def test_fetcher(tmp_path):
    answers, waits = [(503, "", b""), (200, "text/html", b"ok")], []
    f = rawstore.Fetcher(str(tmp_path), get=lambda u, t: answers.pop(0), sleep=waits.append)
    assert f.fetch("s", "http://x")[1] == b"ok" and 2.0 in waits
    assert f.fetch("s", "http://x")[1] == b"ok" and not answers  # from the store
    answers.append((404, "", b""))
    with pytest.raises(OSError):
        f.fetch("s", "http://y")


def test_tables_and_sinks(spark, tmp_path):
    (tmp_path / "m.csv").write_text('date,tickers\n1997-05-05,"A,brk-b"\n1996-01-02,"A,odd ticker!"\n')
    rows = [tuple(r) for r in tables.membership_list(spark, str(tmp_path / "m.csv")).collect()]
    assert rows == [(dt.date(1996, 1, 2), ["A", "ODD TICKER!"]), (dt.date(1997, 5, 5), ["A", "BRK.B"])]
    hints = tables.curated(spark, str(tmp_path))
    assert all(df.count() == 0 for df in hints.values())
    df = spark.createDataFrame([("a", ["x", "y"], None, dt.date(2020, 1, 1))], "k string, l array<string>, n string, d date")
    artefacts.write_csv(df, str(tmp_path / "out"), one_file=True)
    assert tables.artefact(spark, str(tmp_path / "out"), "k string, l string, n string, d date").first() == ("a", "x;y", None, dt.date(2020, 1, 1))
    for k in ("one", "two"):
        artefacts.publish({"t": df.withColumn("k", F.lit(k))}, str(tmp_path / "db"))
        artefacts.append_run(spark, str(tmp_path / "db"), {"built_at": k})
        assert tables.stored_table(spark, str(tmp_path / "db"), "t").first()["k"] == k
    assert spark.read.parquet(str(tmp_path / "db/build_runs")).count() == 2
    (tmp_path / "db/versions/99990101T000000000000-unfinished/t").mkdir(parents=True)
    assert tables.stored_table(spark, str(tmp_path / "db"), "t").first()["k"] == "two"
    artefacts.publish({"t": df}, str(tmp_path / "db"))
    assert len(list((tmp_path / "db/versions").iterdir())) == 2
    with pytest.raises(FileNotFoundError):
        artefacts.current(spark, str(tmp_path / "nothing"))
    artefacts.write_log(df, str(tmp_path / "log"))
    artefacts.write_text(spark, str(tmp_path / "r.md"), "# é\n")
    assert (tmp_path / "r.md").read_text() == "# é\n"
    assert '"l":["x","y"]' in artefacts.to_json(df).first()["json"]


def test_streaming(spark, tmp_path):
    from tidemark.streaming import membership

    rows = [(1, dt.datetime(2020, 1, 1), "ADD"), (1, dt.datetime(2020, 1, 5), "REMOVE"), (2, dt.datetime(2020, 1, 2), "REMOVE"), (1, dt.datetime(2020, 1, 9), "ADD")]
    spark.createDataFrame(rows, "company_id long, at timestamp, action string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("company_id long, at timestamp, action string").parquet(str(tmp_path / "in"))
    q = membership.closed_spells(stream).writeStream.format("memory").queryName("spells").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    out = {tuple(r) for r in spark.table("spells").collect()}
    assert out == {(1, dt.date(2020, 1, 1), dt.date(2020, 1, 5), False), (2, None, dt.date(2020, 1, 2), True)}

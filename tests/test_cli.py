"""The command line from pages on a server to answers, in a world of its own."""

import http.server
import json
import threading

import pytest

from tests.test_sources import page
from tidemark import cli
from tidemark.config import CHANGES, DATE_ADDED, REFERENCE, REVISION, REVISION_LOOKUP, Settings
from tidemark.plans import routes
from tidemark.plans.api import Membership
from tidemark.sinks import artefacts

HEADER = ["Company", "Ticker", "Sector", "Sub industry", "Address", "Date first added", "CIK", "Founded"]
ORBIT, FERN, KELP = (["Orbit", "ORB", "Space", "", "", "2003-02-03", "", ""], ["Fern", "FERN", "Plants", "", "", "2001-05-07", "", ""], ["Kelp Farms", "KELP", "Sea", "", "", "2001-02-01", "", ""])
PAGES = {
    "/changes": page("changes", ["When", "In", "Name", "Out", "Name", "Why"], [["3 February 2003", "ORB", "Orbit", "KELP", "Kelp Farms", "Orbit acquired Kelp Farms.", ""], ["7 May 2001", "FERN", "Fern", "", "", "", ""], ["1 April 2002", "X"]]),
    "/today": page("constituents", HEADER, [ORBIT, FERN]),
    "/revision/7": page("constituents", HEADER, [KELP, FERN]),
    "/lookup/2002-01-01": '{"query": {"revid": 7, "timestamp": "2002-01-03T00:00:00Z"}}',
    "/Historical.csv": 'date,tickers\n2001-01-02,"KELP"\n2001-05-07,"KELP,FERN"\n2003-02-03,"FERN,ORB"\n',
}


@pytest.fixture(scope="module")
def settings(tmp_path_factory):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            body = PAGES.get(self.path, "{}" if self.path.startswith("/lookup/") else "").encode()
            self.send_response(200 if body else 404)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    s = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    root, at = tmp_path_factory.mktemp("cli"), f"http://127.0.0.1:{s.server_port}"
    (root / "curated").mkdir()
    listed = [(CHANGES, "/changes"), (DATE_ADDED, "/today"), (REFERENCE, "/Historical.csv"), (REVISION_LOOKUP, "/lookup/{date}"), (REVISION, "/revision/{revid}")]
    (root / "curated/sources.csv").write_text("source,url\n" + "".join(f"{n},{at}{u}\n" for n, u in listed))
    yield Settings(str(root / "raw"), str(root / "curated"), str(root / "build"), str(root / "store"), requests_per_second=1000.0)
    s.shutdown()


def test_scrape_build_load_and_serve(spark, settings, tmp_path):
    assert cli.run_scrape(spark, settings) == 4
    manifest = cli.run_build(spark, settings, "2024-01-01")
    assert manifest["n_companies"] == 3 and manifest["n_intervals"] == 3 and manifest["n_parse_problems"] == 1
    written = lambda name: spark.read.csv(f"{settings.build_dir}/csv/{name}", header=True, escape='"').collect()
    assert {r["ticker_at_event"] for r in written("events")} == {"ORB", "KELP", "FERN"} and len(written("candidates")) > 3
    assert [(r["source"], r["row"]) for r in written("parse_problems")] == [(CHANGES, "1 April 2002 | X")]
    assert spark.read.json(f"{settings.build_dir}/resolution_log").where("op = 'create'").count() == 3
    report = artefacts.read_text(spark, f"{settings.build_dir}/reconciliation/report.md")
    assert report.startswith("# Reconciliation") and "2024-01-01" in report
    with pytest.raises(FileNotFoundError):
        Membership.load(spark, settings.store_dir)
    assert cli.run_load(spark, settings)["companies"] == 3

    s = routes.server(lambda: Membership.load(spark, settings.store_dir, "2024-01-01"), port=0)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    import urllib.error
    import urllib.request

    def get(path):
        with urllib.request.urlopen(f"http://127.0.0.1:{s.server_port}{path}", timeout=120) as r:
            return json.loads(r.read())

    try:
        assert {t for r in get("/constituents?date=2002-06-01")["constituents"] for t in r["tickers"]} == {"KELP", "FERN"}
        assert {t for r in get("/constituents?date=2003-02-03")["constituents"] for t in r["tickers"]} == {"ORB", "FERN"}
        assert get("/quality")["build"]["n_companies"] == 3
        with pytest.raises(urllib.error.HTTPError) as e:
            get("/companies/nobody")
        assert e.value.code == 404
    finally:
        s.shutdown()

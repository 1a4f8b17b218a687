"""The questions as GET routes that answer with JSON, on the standard library's server.

Answers are reports of bounded size (the members of a day, the events of a range, counts by year). Dates that aren't ISO
give 400, numbers that aren't numbers 422, unknown companies and paths 404. A request without a required parameter
gives 422.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, unquote, urlsplit

from pyspark.sql import DataFrame

from .. import __version__
from ..sinks.artefacts import to_json
from .api import Membership, iso

_NEEDED = object()


class Refused(Exception):
    """An answer other than 200."""

    def __init__(self, status: int, detail: str):
        super().__init__(detail)
        self.status, self.detail = status, detail


class Query:
    """The parameters of a request, read by kind."""

    def __init__(self, text: str):
        self.given = {k: v[-1] for k, v in parse_qs(text, keep_blank_values=True).items()}

    def get(self, name: str, read: Callable = str, default=_NEEDED):
        if name not in self.given:
            if default is _NEEDED:
                raise Refused(422, f"{name} is missing")
            return default
        try:
            return read(self.given[name])
        except ValueError:
            raise Refused(422, f"{name}: {self.given[name]!r} can't be read") from None

    def date(self, name: str, default=_NEEDED) -> str:
        text = self.get(name, str, default)
        try:
            return iso(text)
        except ValueError:
            raise Refused(400, f"{name} must be YYYY-MM-DD, not {text!r}") from None

    def flag(self, name: str) -> bool:
        return self.get(name, _boolean, False)


def _boolean(text: str) -> bool:
    if text.lower() in ("1", "true", "yes", "on"):
        return True
    if text.lower() in ("0", "false", "no", "off"):
        return False
    raise ValueError(text)


def rows(df: DataFrame) -> list[dict]:
    return [json.loads(r["json"]) for r in to_json(df).toLocalIterator()]


def _counted(name: str, found: list[dict], **more) -> dict:
    return {**more, "count": len(found), name: found}


def _quality(m: Membership, q: Query | None = None) -> dict:
    issues, review = m.quality()
    run = m.latest_run.first() if m.latest_run is not None else None
    return {
        "build": json.loads(run["manifest_json"]) if run else None,
        "issues": {r["kind"]: r["n"] for r in issues.toLocalIterator()},
        "discrepancies": {f"{r['comparison']}/{r['severity']}/{r['kind']}": r["n"] for r in m.discrepancy_counts().toLocalIterator()},
        "companies_needing_review": review,
    }


def _constituents(m: Membership, q: Query) -> dict:
    on = q.date("date")
    return _counted("constituents", rows(m.constituents(on, q.flag("include_unsupported"))), date=on)


def _changes(m: Membership, q: Query) -> dict:
    action = q.get("action", str, None)
    found = m.changes(q.date("start_date"), q.date("end_date"), [action] if action else None, q.get("min_confidence", float, 0.0))
    return _counted("changes", rows(m.shaped(found)))


def _company(m: Membership, q: Query, company: str) -> dict:
    try:
        found = rows(m.history(company))
    except LookupError as e:
        raise Refused(404, f"{e.args[0]} (a label, an id or a part of a name)") from None
    return {"matches": len(found), "companies": found}


def _sectors(m: Membership, q: Query) -> dict:
    on = q.date("date")
    return {"date": on, "sectors": rows(m.sector_composition(on))}


def _duration(m: Membership, q: Query) -> dict:
    stats, histogram = m.durations()
    return {**rows(stats)[0], "histogram": rows(histogram)}


ROUTES: dict[str, Callable[[Membership, Query], dict]] = {
    "/": lambda m, q: {"routes": [*ROUTES, "/companies/{company}"]},
    "/health": lambda m, q: {"status": "ok", "version": __version__, "quality": _quality(m)},
    "/constituents": _constituents,
    "/changes": _changes,
    "/memberships/longest": lambda m, q: {"memberships": rows(m.longest(q.get("limit", int, 25), None, q.flag("current_only")))},
    "/exits": lambda m, q: _counted("exits", rows(m.exits(q.date("start_date"), q.date("end_date"), q.get("reason_category", str, None)))),
    "/analytics/turnover": lambda m, q: {"turnover": rows(m.turnover(q.get("start_year", int, 2001), q.get("end_year", int, None)))},
    "/analytics/exit-reasons": lambda m, q: {"exit_reasons": rows(m.exit_reasons(q.get("start_year", int, 2001)))},
    "/analytics/sectors": _sectors,
    "/analytics/duration": _duration,
    "/analytics/survival": lambda m, q: {"curve": rows(m.survival(q.date("cohort_start", "2001-01-01"), q.date("cohort_end", "2026-12-31")))},
    "/cemetery": lambda m, q: _counted("companies", rows(m.cemetery(q.get("limit", int, 2000)))),
    "/quality": _quality,
}


def answer(m: Membership, target: str) -> tuple[int, dict]:
    """Status and body for a path with its query string."""
    url = urlsplit(target)
    q = Query(url.query)
    try:
        if url.path in ROUTES:
            return 200, ROUTES[url.path](m, q)
        if url.path.startswith("/companies/") and (company := unquote(url.path.removeprefix("/companies/"))):
            return 200, _company(m, q, company)
        raise Refused(404, f"no route {url.path}")
    except Refused as e:
        return e.status, {"detail": e.detail}


def server(load: Callable[[], Membership], host: str = "127.0.0.1", port: int = 8000) -> ThreadingHTTPServer:
    """A server that asks load() for the tables at each request, so a newly published version is seen at once."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, body = answer(load(), self.path)
            text = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(text)))
            self.end_headers()
            self.wfile.write(text)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)

"""Append-only store of fetched bodies, addressed by content, with a manifest per source; and its scans."""

from __future__ import annotations

import hashlib
import json
import re
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.analytics import latest_by
from ..schemas import MANIFEST


def manifest(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    """The manifest's rows, with `line`, their order among fetches of equal times."""
    rows = spark.read.schema(MANIFEST).json(f"{raw_dir}/{source}/manifest.jsonl")
    return rows.where(F.col("url").isNotNull()).withColumn("line", F.monotonically_increasing_id())


def latest(spark: SparkSession, raw_dir: str, source: str, url_contains: str | None = None) -> DataFrame:
    """The newest fetch (the first of equal ones) of a source, or of its URLs with that part. An error if there is none."""
    rows = manifest(spark, raw_dir, source)
    if url_contains:
        rows = rows.where(F.col("url").contains(url_contains))
    found = latest_by(rows.withColumn("_all", F.lit(1)), ["_all"], "fetched_at", "line").drop("_all")
    if not found.limit(1).count():
        raise FileNotFoundError(f"no snapshot of {source} ({url_contains})")
    return found


def latest_per_url(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    return latest_by(manifest(spark, raw_dir, source), ["url"], "fetched_at", "line")


def revisions(spark: SparkSession, raw_dir: str, source: str) -> DataFrame:
    """(on_date, …): per requested date ("snapshot for <date>" in the note) the newest fetch."""
    rows = manifest(spark, raw_dir, source).withColumn("on_date", F.to_date(F.regexp_extract("note", r"^snapshot for .*?(\d{4}-\d\d-\d\d)$", 1)))
    return latest_by(rows.where(F.col("note").startswith("snapshot for ")), ["on_date"], "fetched_at", "line").orderBy("on_date")


def bodies(spark: SparkSession, raw_dir: str, snapshots: DataFrame) -> DataFrame:
    """snapshots with `text`; a body whose hash isn't the manifest's is an error."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(raw_dir)
    files = files.select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("path"), "content")
    held = snapshots.join(files, "path", "left")
    wrong = F.raise_error(F.concat(F.lit("sha256 mismatch: "), "path"))
    checked = F.when(F.sha2("content", 256) == F.col("sha256"), F.decode("content", "utf-8")).otherwise(wrong.cast("string"))
    return held.withColumn("text", checked).drop("content")


def revision_of(text) -> tuple:
    """(revid, timestamp) Columns of a revision lookup's JSON, by the first occurrence of each."""
    revid = F.regexp_extract(text, r'"revid":\s*(\d+)', 1)
    at = F.regexp_extract(text, r'"timestamp":\s*"([^"]+)"', 1)
    return F.nullif(revid, F.lit("")).cast("long"), F.nullif(at, F.lit(""))


def put(raw_dir: str, source: str, url: str, body: bytes, status: int = 200, content_type: str = "", ext: str = "html", note: str = "", at: datetime | None = None) -> dict:
    """Adds a manifest line; the body is written unless it is there already. Nothing is overwritten."""
    at = at or datetime.now(timezone.utc)
    folder, digest = Path(raw_dir) / source, hashlib.sha256(body).hexdigest()
    folder.mkdir(parents=True, exist_ok=True)
    lines = folder / "manifest.jsonl"
    known = [json.loads(x) for x in lines.read_text().splitlines() if x.strip()] if lines.exists() else []
    same = [k for k in known if k["url"] == url]
    newest = max(same, key=lambda k: k["fetched_at"]) if same else None
    if newest and newest["sha256"] == digest and (Path(raw_dir) / newest["path"]).exists():
        where = newest["path"]
    else:
        where = f"{source}/{at:%Y%m%dT%H%M%SZ}_{digest[:10]}.{ext}"
        file = Path(raw_dir) / where
        if not file.exists() or file.read_bytes() != body:  # another URL may have given the same body in the same second
            with file.open("xb") as f:
                f.write(body)
    row = {"source": source, "url": url, "fetched_at": f"{at:%Y-%m-%dT%H:%M:%SZ}", "sha256": digest, "path": where, "status": status, "content_type": content_type, "n_bytes": len(body), "note": note}
    with lines.open("a") as f:
        f.write(json.dumps(row) + "\n")
    return row


class Fetcher:
    """Polite fetching into the store: cached bodies first, a pause between requests, retries with growing waits."""

    RETRY = (429, 500, 502, 503, 504)

    def __init__(self, raw_dir: str, per_second: float = 1.0, timeout: float = 60.0, attempts: int = 4, get: Callable[[str, float], tuple[int, str, bytes]] | None = None, sleep: Callable[[float], None] = time.sleep):
        self.raw_dir, self.pause, self.timeout, self.attempts, self.sleep = raw_dir, 1 / per_second, timeout, attempts, sleep
        self.get, self._last = get or self._http, -1e9

    @staticmethod
    def _http(url: str, timeout: float) -> tuple[int, str, bytes]:
        try:
            with urllib.request.urlopen(url, timeout=timeout) as r:  # noqa: S310
                return r.status, r.headers.get("Content-Type", ""), r.read()
        except urllib.error.HTTPError as e:
            return e.code, "", b""

    def fetch(self, source: str, url: str, max_age_s: float | None = None, ext: str = "html", note: str = "", force: bool = False) -> tuple[dict, bytes]:
        lines = Path(self.raw_dir) / source / "manifest.jsonl"
        same = [k for k in map(json.loads, lines.read_text().splitlines()) if k["url"] == url] if lines.exists() else []
        if same and not force:
            newest = max(same, key=lambda k: k["fetched_at"])
            age = (datetime.now(timezone.utc) - datetime.fromisoformat(newest["fetched_at"].replace("Z", "+00:00"))).total_seconds()
            if max_age_s is None or age <= max_age_s:
                return newest, (Path(self.raw_dir) / newest["path"]).read_bytes()
        for attempt in range(self.attempts):
            self.sleep(max(0.0, self._last + self.pause - time.monotonic()))
            self._last = time.monotonic()
            try:
                status, kind, body = self.get(url, self.timeout)
            except OSError:
                status, kind, body = 599, "", b""
            if status < 400:
                return put(self.raw_dir, source, url, body, status, kind, ext, note), body
            if status not in self.RETRY and status != 599:
                break
            if attempt + 1 < self.attempts:
                self.sleep(min(30.0, 2.0 * 2**attempt))
        raise OSError(f"{url}: status {status}")


def fetch_revisions(fetcher: Fetcher, dates: Iterable[str], lookup_source: str, lookup_url: str, source: str, page_url: str) -> list[tuple[str, int]]:
    """(date, revid) of the revisions fetched: for each date the lookup ({date} in its url) names one, whose page ({revid}
    in its url) is stored under the note that revisions() reads. Revisions never change, so what is stored is not fetched
    again; a date without a revision is left out."""
    found = []
    for on in dates:
        _, body = fetcher.fetch(lookup_source, lookup_url.replace("{date}", on), ext="json")
        match = re.search(rb'"revid":\s*(\d+)', body)
        if match is None:
            continue
        revid = int(match[1])
        fetcher.fetch(source, page_url.replace("{revid}", str(revid)), note=f"snapshot for {on}")
        found.append((on, revid))
    return found

"""Constants that the semantics rest on. Fixed values."""

from __future__ import annotations

from dataclasses import dataclass

CONTINUITY_DAYS = 400
MEMBERSHIP_TOLERANCE_DAYS = 45
CLUSTER_TOLERANCE_DAYS = 10
PAIR_TOLERANCE_DAYS = 3
RENAME_MIN_PRIOR_DAYS = 30
SECTOR_LOOKBACK_DAYS = 400
YEAR_DAYS = 365.25
UNKNOWN_ENTRY = "1996-01-02"
CORROBORATION_BUMP, CONFIDENCE_CAP = 0.05, 0.99

#: Weight of a dated sighting of a label, by kind.
EVIDENCE_WEIGHT = {"remove": 1.0, "snapshot": 1.0, "current": 1.0, "curated": 1.0, "reference": 0.8, "add": 0.5}
#: Kinds of sightings in the order in which they are trusted for when a label was in use.
EVIDENCE_TIERS = (("snapshot", "remove", "current", "curated"), ("reference",), ("add",))

CHANGES, DATE_ADDED, REVISION, REVISION_LOOKUP, REFERENCE, CURATED = "wikipedia_changes", "wikipedia_constituents", "wikipedia_revision", "wikipedia_revision_lookup", "reference_fja05680", "curated"
#: Confidence of a claim, by source.
SOURCE_CONFIDENCE = {CHANGES: 0.90, CHANGES + "_with_ref": 0.95, DATE_ADDED: 0.75, REVISION: 0.70, REFERENCE: 0.60, REFERENCE + "_opening": 0.50, CURATED: 0.99}

ADD, REMOVE, TICKER_CHANGE = "ADD", "REMOVE", "TICKER_CHANGE"


@dataclass(frozen=True)
class Settings:
    """What a build takes from outside."""

    raw_dir: str = "data/raw"
    curated_dir: str = "data/curated"
    build_dir: str = "data/build"
    store_dir: str = "data/store"
    window_start: str = "2001-01-01"
    window_end: str = "2026-12-31"
    requests_per_second: float = 1.0
    timeout_s: float = 60.0
    attempts: int = 4

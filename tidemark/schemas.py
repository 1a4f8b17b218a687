"""Schemas of the logical tables, as DDL."""

from __future__ import annotations

CANDIDATES = (
    "effective_date date, action string, ticker string, name string, source_type string, source_url string, scraped_at string, confidence double, "
    "reason string, reason_category string, counterpart_ticker string, raw_sha256 string, notes string, refs array<string>, company_id string"
)
CHANGE_ROWS = "effective_date date, added_ticker string, added_name string, removed_ticker string, removed_name string, reason string, refs array<string>, row_index int"
PAGE_ROWS = "ticker string, name string, gics_sector string, gics_sub_industry string, headquarters string, date_added date, date_added_raw string, cik string, founded string, href string"
PROBLEMS = "where string, row array<string>, error string"
MANIFEST = "source string, url string, fetched_at string, sha256 string, path string, status int, content_type string, n_bytes long, note string"
REFERENCE_SNAPSHOTS = "on_date date, tickers array<string>"
REFERENCE_INTERVALS = "ticker string, start date, end date"
COMPANIES = "company_id string, canonical_name string, name_key string, current_ticker string, cik string, needs_review boolean, notes string"
COMPANY_NAMES = "company_id string, name string, first_seen date"
COMPANY_TICKERS = "company_id string, ticker string, valid_from date, valid_to date, evidence_kinds string, first_evidence date, last_evidence date"
EVENTS = (
    "event_id string, effective_date date, action string, company_id string, ticker_at_event string, company_name string, reason string, reason_category string, "
    "counterpart_company_id string, source_url string, source_type string, scraped_at string, raw_sha256 string, confidence double, "
    "corroborating_sources array<string>, refs array<string>, notes string, in_window boolean"
)
INTERVALS = (
    "company_id string, entry_date date, exit_date date, entry_event_id string, exit_event_id string, entry_ticker string, exit_ticker string, "
    "exit_reason_category string, left_censored boolean, supported boolean"
)
SECTORS = "company_id string, ticker string, as_of_date date, gics_sector string, gics_sub_industry string, source_url string, source_type string, scraped_at string"
ISSUES = "company_id string, kind string, on_date date, detail string"
DISCREPANCIES = "comparison string, severity string, kind string, ticker string, company_id string, company_name string, first_date date, last_date date, n_dates long"
EVIDENCE = "company_id string, ticker string, on_date date, kind string"
CLAIMS = "company_id string, on_date date, action string, source_type string"

"""Row types of the raw, clean and operational tables."""

from __future__ import annotations

ENVELOPE = "source string, job_key string, content_hash string, scraped_at timestamp, run_id string, payload variant"
RAW = f"id long, {ENVELOPE}, loaded_at timestamp"
SIGHTING = "source string, job_key string, seen_on date, fetched boolean"
INGEST_LOG = "source string, run_id string, seen long, inserted long, loaded_at timestamp"

#: What every source is mapped to before cleaning.
COMMON = """url string, title string, company string, location_text string, remote_hint boolean, date_posted string,
valid_through string, employment_type string, industry string, description_html string, skills_text string,
base_currency string, base_low string, base_high string, base_single string, base_unit string, salary_text string"""

POSTING = """source string, job_key string, raw_id long, url string, title_raw string, title_clean string,
title_norm string, seniority string, company string, company_norm string, location_raw string, county string,
county_code int, is_remote boolean, employment_type string, industry string, date_posted date, valid_through date,
salary_currency string, salary_min decimal(14,2), salary_max decimal(14,2), salary_period string,
salary_min_monthly_kes decimal(14,2), salary_max_monthly_kes decimal(14,2), salary_source string,
description_text string, dedup_key string, first_seen_at timestamp, last_seen_at timestamp"""

JOB_SKILL = "source string, job_key string, skill string, category string"
DQ_RESULT = "run_at timestamp, check_name string, layer string, severity string, violations long, total long, passed boolean, detail string"
RUN = "id long, started_at timestamp, finished_at timestamp, status string, summary string"
ALERT = "fingerprint string, level string, subject string, channels string, sent_at timestamp"

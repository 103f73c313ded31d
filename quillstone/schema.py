"""Schemas of the document ledger and the tables around it, always declared."""

LEDGER = """bank_code STRING, doc_type STRING, title STRING, pdf_url STRING, source_url STRING, date DATE,
language STRING, provenance STRING, mime_type STRING, sha256 STRING, local_path STRING, html_path STRING,
date_precision STRING, date_source STRING, repec_handle STRING, alt_urls ARRAY<STRING>, doc_id STRING, year INT"""
FAILURES = "ts STRING, label STRING, bank_code STRING, doc_type STRING, title STRING, pdf_url STRING, alt_urls ARRAY<STRING>, source_url STRING, error STRING"
DISCOVERY_FAILURES = "bank STRING, context STRING, url STRING, error STRING"
DATE_INDEX = "key STRING, title_norm STRING, date STRING, date_source STRING, evidence_url STRING, date_precision STRING, resolved_at STRING"
PAGES = "url STRING, fetched_at TIMESTAMP, status INT, mime STRING, body BINARY"
#: Defaults of a new record.  Old rows without a precision stay without one:
#: null is not 'day'.
NEW_RECORD = {"language": "en", "provenance": "bank_site", "date_precision": "day", "date_source": "bank_site", "repec_handle": "", "source_url": ""}
DATE_PRECISIONS = ("day", "month", "year")
DATE_SOURCES = ("bank_site", "repec", "wayback", "pdf_meta", "nep_bound", "llm_crawl")

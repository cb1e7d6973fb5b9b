"""Schemas of records, documents and their tables, as DDL."""

from __future__ import annotations

CONTENT_TYPE = "struct<top:string,sub:string,charset:string>"
RAW_RECORD = (
    "filename string, rec_seq bigint, format string, url string, date_str string, date timestamp, length bigint, "
    "mimetype string, warc_type string, is_http boolean, status int, headers map<string,string>, "
    "payload_digest string, payload binary, error string"
)
PARSED_RECORD = (
    "filename string, digest string, url string, date timestamp, title string, length bigint, content string, "
    f"suppliedContentType {CONTENT_TYPE}, detectedContentType {CONTENT_TYPE}, isRevisit boolean, outlinks array<bigint>"
)
#: parsed records as JSON has them: dates are epoch milliseconds, what is missing is left out
JSON_RECORD = PARSED_RECORD.replace("date timestamp", "date bigint")
PARSE_LOG = "arcname string, path string, status string, n_records bigint, error string"
OCCURRENCE = "id string, arcname string, date timestamp, job string, ingest_seq bigint"

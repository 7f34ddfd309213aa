"""Declared schemas of crawl payloads."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
STR_MAP = T.MapType(S, S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


WARC_RECORD = _struct(
    path=S, record_seq=L, record_type=S, url=S, headers=STR_MAP, content=T.BinaryType(), status_code=I, warc_headers=STR_MAP
)

NAME_VALUE = T.ArrayType(_struct(name=S, value=S))

HAR_ENTRY = _struct(
    startedDateTime=S,
    time=D,
    timings=T.MapType(S, D),
    request=_struct(method=S, url=S, headers=NAME_VALUE),
    response=_struct(
        status=S, statusText=S, headers=NAME_VALUE, content=_struct(size=L, mimeType=S, text=S, encoding=S)
    ),
)

CRAWL_STATE = _struct(
    urls_visited=L,
    urls_extracted=L,
    urls_to_crawl=L,
    urls_failed=L,
    urls_skipped=L,
    api_credit_used=D,
    duration=D,
    start_time=D,
    stop_time=D,
    stop_reason=S,
)

# state fields that must be present; the other three are null while a crawl is pending
REQUIRED_STATE = (
    "urls_visited",
    "urls_extracted",
    "urls_to_crawl",
    "urls_failed",
    "urls_skipped",
    "api_credit_used",
    "duration",
)

CRAWL_STATUS = _struct(crawler_uuid=S, uuid=S, status=S, is_success=B, is_finished=B, state=CRAWL_STATE)

EVENT_PAYLOAD = _struct(
    crawler_uuid=S,
    project=S,
    env=S,
    action=S,
    state=CRAWL_STATE,
    seed_url=S,
    url=S,
    scrape=_struct(status_code=I, country=S, log_uuid=S, log_url=S, content=STR_MAP),
    urls=STR_MAP,
    origin=S,
    discovered_urls=T.ArrayType(S),
    error=S,
    scrape_config=T.VariantType(),
    links=_struct(status=S, log=S, scrape=S),
)

EVENT_ENVELOPE = _struct(event=S, payload=EVENT_PAYLOAD)

SCRAPE_ERROR = _struct(code=S, message=S, retryable=B, http_code=I, doc_url=S, description=S, links=S)

SCRAPE_ENVELOPE = _struct(
    config=T.VariantType(),
    context=T.VariantType(),
    result=_struct(
        url=S,
        status=S,
        status_code=I,
        reason=S,
        success=B,
        format=S,
        content=S,
        duration=D,
        log_url=S,
        request_headers=STR_MAP,
        response_headers=STR_MAP,
        screenshots=T.VariantType(),
        dns=T.VariantType(),
        ssl=T.VariantType(),
        iframes=T.VariantType(),
        browser_data=T.VariantType(),
        error=SCRAPE_ERROR,
    ),
    error_id=S,
    message=S,
    http_code=I,
)

EXTRACTION_ENVELOPE = _struct(data=T.VariantType(), content_type=S, error_id=S, message=S, http_code=I)

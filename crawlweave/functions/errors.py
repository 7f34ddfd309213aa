"""Error codes: their parts, classes and messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# fixed values: error codes of the documented reactions
FATAL_CODES = (
    "ERR::SCRAPE::PROJECT_QUOTA_LIMIT_REACHED",
    "ERR::SCRAPE::QUOTA_LIMIT_REACHED",
    "ERR::THROTTLE::MAX_API_CREDIT_BUDGET_EXCEEDED",
    "ERR::ACCOUNT::PAYMENT_REQUIRED",
    "ERR::ACCOUNT::SUSPENDED",
)
THROTTLE_CODES = (
    "ERR::THROTTLE::MAX_REQUEST_RATE_EXCEEDED",
    "ERR::THROTTLE::MAX_CONCURRENT_REQUEST_EXCEEDED",
    "ERR::PROXY::RESOURCES_SATURATION",
    "ERR::SESSION::CONCURRENT_ACCESS",
)
MONITORED_CODES = (
    "ERR::ASP::SHIELD_ERROR",
    "ERR::ASP::SHIELD_PROTECTION_FAILED",
    "ERR::API::INTERNAL_ERROR",
)
BAD_UPSTREAM = "ERR::SCRAPE::BAD_UPSTREAM_RESPONSE"
THROTTLE_PAUSE_SECONDS = 5
RETRY_DELAY_SECONDS = 5
RETRY_TIMES = 3

# fixed values: error class by resource and by status of the service
RESOURCE_CLASS = {
    "SCRAPE": "ScrapeError",
    "WEBHOOK": "WebhookError",
    "PROXY": "ProxyError",
    "SCHEDULE": "ScheduleError",
    "ASP": "AspError",
    "SESSION": "SessionError",
}
STATUS_CLASS = {401: "BadApiKeyError", 402: "PaymentRequired", 429: "TooManyRequest"}

# fixed values: error class -> parent class
CLASS_PARENT = {
    "ServiceError": None,
    "HttpError": "ServiceError",
    "UpstreamHttpError": "HttpError",
    "UpstreamHttpClientError": "UpstreamHttpError",
    "UpstreamHttpServerError": "UpstreamHttpClientError",
    "ApiHttpClientError": "HttpError",
    "ApiHttpServerError": "ApiHttpClientError",
    "BadApiKeyError": "ApiHttpClientError",
    "PaymentRequired": "ApiHttpClientError",
    "TooManyRequest": "ApiHttpClientError",
    "ScraperAPIError": "HttpError",
    "ScrapeError": "ScraperAPIError",
    "WebhookError": "ScraperAPIError",
    "ProxyError": "ScraperAPIError",
    "ScheduleError": "ScraperAPIError",
    "AspError": "ScraperAPIError",
    "SessionError": "ScraperAPIError",
}


def error_resource(code: Column) -> Column:
    """Middle part of ``ERR::<resource>::<name>``; null for any other shape."""
    parts = F.split(code, "::", -1)
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(1)))


def error_class(kind_is_http: Column, http_code: Column, code: Column) -> Column:
    """Class name of an error.

    ``kind_is_http``: the service itself answered with a non-2xx status.
    """
    resource = error_resource(code)
    by_resource = F.create_map(*[F.lit(v) for pair in RESOURCE_CLASS.items() for v in pair])[resource]
    by_status = F.lit(None).cast("string")
    for status, name in STATUS_CLASS.items():
        by_status = F.when(http_code == status, name).otherwise(by_status)
    service = F.when(http_code >= 500, "ApiHttpServerError").otherwise(
        F.coalesce(by_resource, by_status, F.lit("ApiHttpClientError"))
    )
    upstream = (
        F.when((code == BAD_UPSTREAM) & (http_code >= 500), "UpstreamHttpServerError")
        .when((code == BAD_UPSTREAM) & (http_code >= 400), "UpstreamHttpClientError")
        .otherwise(F.coalesce(by_resource, F.lit("ServiceError")))
    )
    return F.when(kind_is_http, service).otherwise(upstream)


def error_message(status: Column, code: Column, message: Column, links: Column) -> Column:
    """``<-- status | code - message.`` with the related documents.

    ``links`` is JSON text: an object (first value is used) or a list.
    """
    as_map = F.map_values(F.from_json(links, "map<string,string>"))
    as_list = F.from_json(links, "array<string>")
    doc = F.when(F.ltrim(links).startswith("["), F.array_join(as_list, ", ")).otherwise(F.get(as_map, F.lit(0)))
    head = F.when(code.isNull(), F.format_string("<-- %s | %s.", status.cast("string"), message)).otherwise(
        F.format_string("<-- %s | %s - %s.", status.cast("string"), code, message)
    )
    return F.when(
        doc.isNotNull() & (doc != ""), F.concat(head, F.lit(" Checkout the related doc: "), doc)
    ).otherwise(head)
